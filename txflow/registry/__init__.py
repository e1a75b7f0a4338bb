"""The queries offered to the driver, their inputs and their SQL counterparts."""
