"""What amount baselines are made of, counted load by load, so that new payments are scored without the old ones.

Each load leaves how often every amount occurs per category and per cardholder;
such counts merge by adding, and exact medians follow from them
(``quantiles.median_and_mad`` with a weight). Payments lie by day (or month), so that
scoring those since a time opens that time's days only. Running a load again replaces
what it left.

* ``<path>/categories/load=<id>``: category, amount, n
* ``<path>/cardholders/load=<id>``: cardholder_id, amount, n
* ``<path>/payments/period=<day or month>/load=<id>``: the payments, with n
"""

from __future__ import annotations

from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.plans.anomaly import amount_anomalies
from txflow.session import children, remove, scratch_dir

SCHEMAS = {
    "categories": "category STRING, amount DOUBLE, n LONG",
    "cardholders": "cardholder_id STRING, amount DOUBLE, n LONG",
    "payments": "trans_num STRING, ts TIMESTAMP, cardholder_id STRING, merchant_id STRING, category STRING, amount DOUBLE, n LONG",
}
_PAYMENT = [field.split()[0] for field in SCHEMAS["payments"].split(", ")[:-1]]


class Baselines:
    """Amounts and payments of all loads under ``path``.

    ``period`` is the same for all loads: months where a load spreads over years.
    """

    def __init__(self, spark: SparkSession, path: str, period: str = "day"):
        self.spark, self.path = spark, path.rstrip("/")
        self._spark_form, self._form = {"day": ("yyyy-MM-dd", "%Y-%m-%d"), "month": ("yyyy-MM", "%Y-%m")}[period]

    def add(self, tx: DataFrame, load: str, replaced: DataFrame | None = None) -> None:
        """Count one load of payments; those without a cardholder are left out, as in scoring.

        What it costs depends on the load only. A record number is counted by each
        load that holds it, so a load must bring new numbers, or name in ``replaced``
        the payments, as they were added before, that its own stand for.
        """
        rows = _signed(tx, 1)
        if replaced is not None:
            rows = rows.unionByName(_signed(replaced, -1))
        # As in scoring: an amount counts once per transaction, and once per cardholder and transaction.
        once = rows.dropDuplicates(["trans_num", "n"])
        own = rows.dropDuplicates(["cardholder_id", "trans_num", "n"])
        self._forget(load)
        for table, part in (("categories", _added(once, "category", "amount")), ("cardholders", _added(own, "cardholder_id", "amount"))):
            self._write(table, part, load, [])
        # One file a period, several where one is large.
        dealt = rows.withColumn("period", F.date_format("ts", self._spark_form)).hint("rebalance", "period")
        self._write("payments", dealt, load, ["period"])

    def _forget(self, load: str) -> None:
        """Take out an earlier attempt, which may have met periods that the next one doesn't.

        Its counts are written first and removed last, so without any there is nothing to look for.
        """
        def mine(folder: str) -> list[str]:
            return [f"{folder}/{name}" for name in children(self.spark, folder) if unquote(name) == f"load={load}"]

        if not mine(f"{self.path}/categories"):
            return
        for period in children(self.spark, f"{self.path}/payments"):
            for folder in mine(f"{self.path}/payments/{period}"):
                remove(self.spark, folder)
        for table in ("cardholders", "categories"):
            for folder in mine(f"{self.path}/{table}"):
                remove(self.spark, folder)

    def _write(self, table: str, rows: DataFrame, load: str, above: list[str]) -> None:
        (rows.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*above, "load").parquet(f"{self.path}/{table}"))

    def _read(self, table: str, folders: list[str] | None = None) -> DataFrame:
        paths = [f"{self.path}/{table}"] if folders is None else [f"{self.path}/{table}/{name}" for name in folders]
        if not paths or not children(self.spark, paths[0]):
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", "true").parquet(*paths)

    def amounts(self, table: str) -> DataFrame:
        """``categories`` or ``cardholders``: how often each amount occurs, over all loads."""
        return _added(self._read(table), *self._read(table).columns[:2])

    def payments(self, since: datetime | None = None) -> DataFrame:
        """Payments of all loads; with ``since`` those of that day or month and later, and no other is listed."""
        left = self._signed_payments(since).groupBy(*_PAYMENT).agg(F.sum("n").alias("n")).where(F.col("n") > 0)
        return left.select(*_PAYMENT, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_copy")).drop("_copy")

    def _signed_payments(self, since: datetime | None) -> DataFrame:
        """The same, not yet set off against those taken back."""
        if since is None:
            return self._read("payments")
        first = f"period={since.strftime(self._form)}"  # payments without a time sort behind the digits
        named = [name for name in children(self.spark, f"{self.path}/payments") if first <= name < "period=:"]
        return self._read("payments", sorted(named))

    def anomalies(self, since: datetime | None = None, *, velocity_seconds: int = 600, **options) -> DataFrame:
        """The same as ``plans.anomaly.amount_anomalies`` over the payments of all loads, those since a UTC time scored.

        Reads the payments of the days since then (and of the time that velocity
        looks back), and of the cardholders' amounts those of cardholders among them.
        """
        own, back = self._read("cardholders"), None
        if since is not None:
            back = since - timedelta(seconds=velocity_seconds)
            own = own.join(self._signed_payments(back).select("cardholder_id").distinct(), "cardholder_id", "left_semi")
            options["since"] = f"{since:%Y-%m-%d %H:%M:%S.%f}"
        # Medians read the added amounts again and again, so they are added up once. Payments are
        # counted as they lie: those taken back count against those they take back.
        shared, own = self._kept(self.amounts("categories")), self._kept(_added(own, "cardholder_id", "amount"))
        signed = self._signed_payments(back)
        sizes = [signed.select(key, F.col("n").alias("rows")).unionByName(table.select(key, F.lit(1).cast("long").alias("rows")))
                 for key, table in (("category", shared), ("cardholder_id", own))]
        return amount_anomalies(self.payments(back), shared, own, weight="n", sizes=tuple(sizes),
                                velocity_seconds=velocity_seconds, **options)

    def _kept(self, rows: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, "amounts")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def _signed(tx: DataFrame, n: int) -> DataFrame:
    known = tx.where(F.col("cardholder_id").isNotNull())
    return known.select(*[F.col(c).cast("double") if c == "amount" else F.col(c) for c in _PAYMENT], F.lit(n).cast("long").alias("n"))


def _added(rows: DataFrame, *by: str) -> DataFrame:
    """Counts added up; what was taken back altogether is gone."""
    return rows.groupBy(*by).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
