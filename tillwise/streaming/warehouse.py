"""The warehouse kept up to date by report uploads.

An upload is a grid of report cells (file, row_idx, cells).  Each micro-batch
routes its files by name, finds their headers, reads receipts and lines, and
brings every table up to date by key; only buckets of receipts and products in the
batch are read and rewritten:

* receipts and lines, all as first reported (a line and its receipt may come in
  different uploads, a report may be uploaded again);
* names, the first-seen id of each product name;
* the fact, by (receipt, date, product): receipts of the batch are worked out
  anew from all their lines, so repeated and late reports fit in;
* product states (id, name, price) with their first and last row, a summary
  that merges, and from it the current and history dimensions of the batch's products;
* receipts' baskets (transaction_records), also of earlier receipts whose
  product got another parent SKU.

The order of rows, which "first seen" and "last wins" go by, is that of arrival:
batch, file name, row.  So the tables after any number of uploads are those of one
run over all of them in this order.  The tables of a batch are published
together, after their foreign keys are checked; a batch that is applied again
leaves the same tables.

Lines are shuffled twice in a batch, into their table and by receipt to their headers.
The joined rows are a bucketed scratch table, of which the fact and the baskets are
grouped and written into their buckets without another shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.cleaning import apply_canonical_ids, first_seen_ids, normalize_names, standardize_products
from ..operators.dimensions import DIM_COLUMNS, derived_columns, product_dim_history
from ..operators.facts import basket_lines, dedup_keep_first, dedup_keep_last, distinct_rows, join_header_lines, transaction_records
from ..operators.keyed import DEAL, STORED, TASK_BYTES, KeyedTable, file_system, folder_bytes, lean_writes
from ..operators.upsert import TABLE_KEYS, publish_checked, write_version
from ..sources.reports import detect_header, header_names, read_columns, route_files
from ..sources.time_dim import time_dimension
from .ingest import stream_ingest

GRID = "file string, row_idx bigint, cells array<string>"
SEQ = "decimal(38,0)"
_HEADER = "receipt_no bigint, date date, time string, datetime timestamp_ntz"
_LINE = "receipt_no bigint, product_id string, product_name string, qty int, price decimal(10,2), line_total decimal(12,2), net_total decimal(12,2)"
_FACT = f"date date, time_id string, {_LINE}"
_DIM = ("product_id string, product_name string, price decimal(10,2), product_cost decimal(10,2), last_transaction_datetime timestamp_ntz, "
        "record_version int, is_current boolean, parent_sku string, category string")
MARKERS = {"sales": C.SALES_HEADER_MARKERS, "product": C.PRODUCT_HEADER_MARKERS}
TAGS = {"sales": C.SALES_FILE_TAG, "product": C.PRODUCT_FILE_TAG}
#: Digits of the file's number in its batch and of the row in the order of arrival.
_FILE_DIGITS, _ROW_DIGITS = 8, 12
#: Receipts of a batch that every task may hold, in stored bytes.
FEW_BYTES = 1 << 20


def _by(key: str):
    """All rows of a key give way to those that arrived for it."""
    return lambda old, new: old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


class WarehouseState:
    """The tables below `root`, one version for each batch."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        table = lambda name, schema, keys, by=None: KeyedTable(spark, f"{self.root}/{name}", schema, keys, by, buckets)
        key = TABLE_KEYS
        self.receipts = table("receipts", f"{_HEADER}, seq {SEQ}", ("receipt_no", "date", "time"), ["receipt_no"])
        self.lines = table("lines", f"{_LINE}, seq {SEQ}, seq_last {SEQ}", [c.split()[0] for c in _LINE.split(", ")], ["receipt_no"])
        self.names = table("names", f"__name_key string, __canon_id string, seq {SEQ}", ("__name_key",))
        self.states = table("states", f"product_id string, product_name string, price decimal(10,2), first {SEQ}, first_dt timestamp_ntz, last {SEQ}, dt_last {SEQ}, last_dt timestamp_ntz",
                            ("product_id", "product_name", "price"), ["product_id"])
        self.tables = {
            "fact_transaction_dimension": table("fact", _FACT, key["fact_transaction_dimension"], ["receipt_no"]),
            "current_product_dimension": table("current", _DIM, key["current_product_dimension"]),
            "history_product_dimension": table("history", _DIM, key["history_product_dimension"], ["product_id"]),
            "transaction_records": table("records", "receipt_no bigint, sku string", key["transaction_records"]),
        }
        self.manifest = f"{self.root}/published"

    # -- reading reports ----------------------------------------------------------
    def _stored(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written under the batch's work folder and read back: a table of known size."""
        return self.spark.read.parquet(write_version(rows, f"{self.root}/work/{name}", options=STORED))

    def _records(self, grid: DataFrame, top: DataFrame, files: DataFrame, dataset: str, columns, batch_id: int) -> DataFrame:
        """Cells by name with the row's place in the order of arrival.  `top` has the rows that may be
        headers, `files` the numbered files: small tables, so the cells are not shuffled to meet them."""
        wide = lambda x, digits: (x * F.lit(10 ** digits).cast("decimal(13,0)")).cast(SEQ)
        number = (wide(F.lit(batch_id).cast(SEQ), _FILE_DIGITS) + F.col("file_no").cast("decimal(10,0)")).cast(SEQ)
        numbers = files.filter(F.col("dataset") == dataset).select("file", wide(number, _ROW_DIGITS).alias("__first"))
        mine = top.join(numbers, "file", "left_semi")
        names = self._stored(header_names(mine, detect_header(mine, MARKERS[dataset])).join(numbers, "file"), "headers")
        # the names of the dataset's files hold its tag, so stored rows of others need not be read
        read = read_columns(grid.filter(F.col("file").contains(TAGS[dataset])), names, columns, ["__first"])
        return read.select(*columns, (F.col("__first") + F.col("row_idx").cast("decimal(18,0)")).cast(SEQ).alias("seq"))

    # -- one batch ------------------------------------------------------------------
    def apply(self, grid: DataFrame, batch_id: int) -> None:
        """Bring all tables to version `batch_id` and publish them."""
        scratch: list[str] = []
        try:
            # a stream's batches have a session of their own
            with lean_writes(self.spark, grid.sparkSession):
                self._apply(grid, batch_id, scratch)
        finally:
            for name in scratch:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _apply(self, grid: DataFrame, v: int, scratch: list[str]) -> None:
        files = route_files(grid.select("file").distinct().withColumn("file_name", F.col("file")))
        files = self._stored(files.withColumn("file_no", F.row_number().over(Window.partitionBy("dataset").orderBy("file"))), "files")
        files.filter("reject_reason is not null").select("file", "reject_reason").write.mode("overwrite").parquet(f"{self.root}/rejected/batch={v:012d}")
        # no header lies below these rows
        top = self._stored(grid.filter(F.col("row_idx") < max(C.HEADER_SEARCH_ROWS, C.DEFAULT_HEADER_ROW + 1)), "top")

        sales = self._records(grid, top, files, "sales", ["Date", "Time", "Receipt No"], v)
        date, time = F.expr("try_cast(`Date` as date)"), F.col("Time")
        headers = sales.select(F.expr("try_cast(`Receipt No` as bigint)").alias("receipt_no"), date.alias("date"), time.alias("time"),
                               F.expr("try_cast(concat(`Date`, ' ', `Time`) as timestamp_ntz)").alias("datetime"), "seq")
        headers = self.receipts.merge(headers, v, reduce=lambda rows: dedup_keep_first(rows, [DEAL, *self.receipts.keys]))
        sold = self._records(grid, top, files, "product", ["Receipt No", "Product ID", "Product Name", "Qty", "Price", "Line Total", "Net Total"], v)
        names = ("receipt_no", "product_id", "product_name", "qty", "price", "line_total", "net_total")
        kinds = [c.split(" ", 1)[1] for c in _LINE.split(", ")]
        typed = sold.toDF(*names, "seq").select(*[F.expr(f"try_cast({c} as {k})").alias(c) for c, k in zip(names, kinds)], "seq")
        typed = standardize_products(typed).withColumn("seq_last", F.col("seq"))
        lines = self.lines.merge(typed, v, reduce=lambda rows: distinct_rows(rows, "seq", "seq_last"))

        self.names.merge(first_seen_ids(lines).select(*self.names.schema.names), v, lambda old, new: dedup_keep_first(old.unionByName(new), ["__name_key"]))

        # a line without a receipt number has no receipt
        touched = self._stored(headers.select("receipt_no").unionByName(lines.select("receipt_no")).filter("receipt_no is not null").distinct(), "receipts")
        self._drop(self.receipts.arrivals, self.lines.arrivals)
        here = self._buckets(touched)
        joined = self._joined(touched, here, v, scratch)
        fact, baskets = self.tables["fact_transaction_dimension"], self.tables["transaction_records"]
        fact_rows = self._replace(fact, self._fact_rows(joined), touched, here, v)
        changed = self._stored(self._products(joined, v), "changed")
        rows, receipts = joined, touched
        if changed.head(1):
            # receipts of other uploads whose product has another parent SKU now
            more = fact.read(v).join(changed, "product_id", "left_semi").select("receipt_no").distinct()
            more = self._stored(more.join(touched, "receipt_no", "left_anti"), "receipts")
            if there := self._buckets(more):
                rows = joined.unionByName(self._joined(more, there, v, scratch))
                receipts, here = touched.unionByName(more), here | there
        records = transaction_records(basket_lines(rows, self.tables["current_product_dimension"].read(v), [DEAL]), [DEAL])
        self._replace(baskets, records, receipts, here, v)
        versions = {name: t.locator(v) for name, t in self.tables.items()} | {"time_dimension": write_version(time_dimension(self.spark), f"{self.root}/time")}
        # dimensions only gain keys, so rows of earlier batches need not be checked again
        publish_checked(self.spark, self.manifest, versions, {"fact_transaction_dimension": fact_rows, "history_product_dimension": joined.select("product_id")})
        # the batch's scratch: published versions lie in the tables' data folders
        self._drop(f"{self.root}/work", *[t.arrivals for t in (self.receipts, self.lines, self.names, self.states, *self.tables.values())])

    def _drop(self, *folders: str) -> None:
        fs, path = file_system(self.spark, self.root)
        for folder in folders:
            fs.delete(path(folder), True)

    def _buckets(self, receipts: DataFrame) -> set[int]:
        """Bucket numbers: as many as a table has buckets."""
        return {r[0] for r in receipts.select(self.lines.bucket()).distinct().collect()}

    def _joined(self, receipts: DataFrame, here: set[int], v: int, scratch: list[str]) -> DataFrame:
        """All lines of the given receipts, with canonical ids and names, once each: a bucketed table in the work folder,
        whose rows are read back as they were dealt."""
        size, name = self.lines.bytes(v, here), f"tillwise_joined_{uuid.uuid4().hex}"
        few = folder_bytes(self.spark, *{f.rsplit("/", 1)[0] for f in receipts.inputFiles()}) < FEW_BYTES
        if few:
            # a small upload: most lines of its buckets belong to other receipts
            size = min(size, TASK_BYTES * self.lines.buckets)
        scratch.append(name)
        dealt = lambda rows: self.lines.dealt(rows, size, ["receipt_no"])
        for some in self.lines.slices(here, size):
            mine, lines = receipts.filter(self.lines.bucket().isin(some)), self.lines.read(v, some).filter("receipt_no is not null")
            lines = lines.join(F.broadcast(mine), "receipt_no", "left_semi") if few else lines
            headers = dealt(self.receipts.read(v, some).drop("seq", "time")).join(dealt(mine).hint("shuffle_hash"), ["receipt_no", DEAL], "left_semi")
            lines = normalize_names(apply_canonical_ids(lines, self.names.read(v).select("__name_key", "__canon_id")))
            # a task's headers are a few MB at most
            rows = join_header_lines(headers.hint("shuffle_hash"), dealt(lines), by=[DEAL])
            # two lines may be equal once their ids are canonical
            rows = distinct_rows(rows, "seq", "seq_last").write.mode("append").bucketBy(self.lines.deals(size)[1], DEAL)
            rows.options(path=f"{self.root}/work/{name}", **STORED).saveAsTable(name, format="parquet")
        return self.spark.table(name)

    def _fact_rows(self, joined: DataFrame) -> DataFrame:
        keys = list(TABLE_KEYS["fact_transaction_dimension"])
        last = dedup_keep_last(joined.drop("seq"), [DEAL, *keys], "seq_last")
        return last.withColumn("time_id", F.date_format("datetime", "'H'HH'M'mm")).select(DEAL, *[c.split()[0] for c in _FACT.split(", ")])

    def _replace(self, table: KeyedTable, rows: DataFrame, receipts: DataFrame, here: set[int], v: int) -> DataFrame:
        """Bring a table to version `v`: dealt `rows` are all that there are of `receipts`, of others the old ones stay."""
        if table.before(v) is not None:
            kept = table.gathered(table.old(v, here).join(receipts, "receipt_no", "left_anti"))
            rows = rows.unionByName(kept.select(*table.schema.names, F.lit(None).cast("int").alias(DEAL)))
        return table.replace([rows], v, here)

    def _products(self, joined: DataFrame, v: int) -> DataFrame:
        """Bring the product tables up to date; returns products of earlier batches whose parent SKU changed."""
        def states(rows):
            return rows.groupBy("product_id", "product_name", "price").agg(
                F.min_by("first_dt", "first").alias("first_dt"), F.min("first").alias("first"), F.max("last").alias("last"),
                F.max_by("last_dt", "dt_last").alias("last_dt"), F.max("dt_last").alias("dt_last")).select(*self.states.schema.names)
        each = joined.select("product_id", "product_name", "price", F.col("seq").alias("first"), F.col("datetime").alias("first_dt"), F.col("seq_last").alias("last"),
                             F.when(F.col("datetime").isNotNull(), F.col("seq_last")).alias("dt_last"), F.col("datetime").alias("last_dt"))
        new = self.states.merge(states(each), v, lambda old, rows: states(old.unionByName(rows)))
        ids = new.select("product_id").distinct()
        here = {r[0] for r in ids.select(self.states.bucket()).distinct().collect()}  # bucket numbers
        mine = self.states.read(v, here).join(ids, "product_id", "left_semi")
        last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("last"))).alias(c)
        current = mine.groupBy("product_id").agg(last("product_name"), last("price"), F.max_by("last_dt", "dt_last").alias("last_transaction_datetime"))
        current = derived_columns(current.withColumns({"record_version": F.lit(1), "is_current": F.lit(True)})).select(*DIM_COLUMNS)
        history = product_dim_history(mine.select("product_id", "product_name", "price", F.col("first_dt").alias("datetime"), F.col("first").alias("seq")))

        was = self.tables["current_product_dimension"]
        now = was.merge(current, v)
        self.tables["history_product_dimension"].merge(history, v, _by("product_id"))
        old = was.read(was.before(v)) if was.before(v) is not None else self.spark.createDataFrame([], was.schema)
        both = old.select("product_id", F.col("parent_sku").alias("was")).join(now.select("product_id", "parent_sku"), "product_id")
        return both.filter(~F.col("was").eqNullSafe(F.col("parent_sku"))).select("product_id")


def stream_warehouse(spark: SparkSession, landing: str, checkpoint: str, root: str, archive_dir: str | None = None, buckets: int = 64) -> WarehouseState:
    """Drain the uploads that have landed into the warehouse below `root`, one batch."""
    state = WarehouseState(spark, root, buckets)
    stream_ingest(spark, landing, GRID, checkpoint, state.apply, archive_dir=archive_dir)
    return state
