"""DataFrame operators over sightings, graph tables and payments."""
