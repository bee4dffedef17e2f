"""End-to-end incremental batch: extract -> transform -> stage -> target.

``run_batch`` is one Spark application step; the driver holds only the marks,
row counts and ``max(address_id)``. A batch writes its deltas and stage tables
below its own stage folder, and later steps read what was staged (the order
fact reads the staged order lines, the customer dimension the staged
addresses), which also cuts the lineage. The ``Completed`` log rows come last:
only then do the marks move and the batch's rows become visible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timeparts as tp
from ..operators import dims, distinct, facts
from ..operators.keys import max_id
from ..sources import control, extract, schemas, segments, sinks, versions
from .jobs import concurrently
from .warehouse import StarSchema

MARK_TABLES = ("stg_dim_customer", "stg_dim_order", "stg_dim_product")
#: Log name of the latest event time loaded, kept by batches that run with ``late_by``.
EVENTS = "events_dim_order"
SCD2_KEYS = {"dim_product": "productid", "dim_customer": "customerid"}
#: Schemas of the staged updates and of the deltas that a batch writes once.
UPDATES = {"dim_product_updates": T.StructType([*schemas.PRODUCT_MASTER.fields, T.StructField("end_date", T.DateType())]),
           "dim_customer_updates": schemas.DIM_CUSTOMER}
DELTAS = {"delta_orders": schemas.ORDER_DETAILS, "delta_customer": schemas.CUSTOMER_MASTER,
          "delta_products": schemas.PRODUCT_MASTER}
STATES = {n: schemas.TARGETS[n].schema for n in schemas.STATES}  # stored by batch, not logged


@dataclass
class BatchResult:
    batch_id: int
    marks: dict[str, str]
    staged: dict[str, int] = field(default_factory=dict)
    run_ts: dt.datetime | None = None
    product_updates: DataFrame | None = None
    customer_updates: DataFrame | None = None
    events: tuple[int, dt.datetime] | None = None  # events read and the event-time mark, with late_by


def _next_batch_id(spark: SparkSession, root: str) -> int:
    """One more than the largest completed batch: the id of a batch that did not
    finish is used again, so its partial output is replaced, never kept beside
    a second copy. Ids that landed files were recorded under are skipped."""
    used = control.completed_ids(spark, sinks.log_path(root)) + control.reserved_ids(spark, sinks.landed_path(root))
    return max(used, default=0) + 1


def extract_and_stage(spark: SparkSession, sources: dict[str, DataFrame], root: str,
                      run_ts: dt.datetime, batch_id: int | None = None,
                      address_dedupe: str = "natural_key", scd2: bool = False,
                      order_delta: DataFrame | None = None, late_by: dt.timedelta | None = None) -> BatchResult:
    """Extract deltas since the marks and write the batch's stage tables.

    ``sources``: customer_master, product_master, order_details, order_items
    (parquet, JDBC or the test-data binding). ``run_ts`` is the batch's wall
    clock: it becomes the next mark and the run date of product versions.
    Each delta is read from its source once, written below the batch's stage
    folder and read back from there by everything that needs it; the lines are
    those of the delta's InProgress orders.

    ``order_delta``: order events to load as they are, whatever their time (a
    landed file is handed out once, so no mark applies to it).

    ``late_by``: how long after its own time the source may commit an order event. The order extract
    then starts that long before the latest event time loaded (never later than the last
    run) and leaves out the events that other batches loaded, so a late event is loaded once and
    no event twice; one that comes later still is not seen. Without it the mark is the last run's clock.

    ``address_dedupe="natural_key"`` (default) gives each distinct address
    one id, so the customer lookup is 1:1. ``"row"`` reproduces the reference
    exactly (a fresh address row per extracted customer), whose lookup returns
    every (customer, address row) pair of a shared address: quadratic in the
    size of a heavily shared address, so it is not the default.

    ``scd2``: changes are found against the open rows of the latest SCD2
    version instead of the append-loaded dimension, which never sees updates.

    Independent stage tables are written as concurrent Spark jobs (two waves:
    the order fact needs the staged lines, the customer dimension the staged
    addresses). Nothing is logged ``Completed`` before the target load.
    """
    log = sinks.log_path(root)
    batch_id = batch_id or _next_batch_id(spark, root)
    # marks from earlier batches only: rerunning a batch (same id) repeats
    # the same extraction and overwrites its own outputs
    marks = control.high_water_marks(spark, log, list(MARK_TABLES), before_logid=batch_id)
    run_date = run_ts.date().isoformat()
    # the dimensions as loaded by all other batches, whatever the order in which they
    # completed (a rerun must not see its own rows)
    existing = {n: sinks.read_target(spark, root, n, except_batch=batch_id) for n in ("dim_address", "dim_customer", "dim_product")}
    res = BatchResult(batch_id, marks, run_ts=run_ts)

    def stage(name: str, df: DataFrame) -> DataFrame:
        schema = UPDATES.get(name) or DELTAS.get(name) or STATES.get(name)
        try:
            n = sinks.write_stage(spark, df, root, name, batch_id, schema)
        except Exception:
            control.append_log(spark, log, batch_id, schemas.STAGE_PREFIX + name, 0, control.FAILED, run_ts)
            raise
        if schema is None:
            res.staged[name] = n
        return sinks.read_stage(spark, root, name, batch_id, schema)

    deltas: dict[str, DataFrame] = {}

    def delta(name: str, df: DataFrame) -> None:
        deltas[name] = stage(name, df)

    orders = sources.get("order_details") if order_delta is None else None
    event_mark = dt.datetime.fromisoformat(control.high_water_marks(spark, log, [EVENTS], before_logid=batch_id)[EVENTS])

    def new_orders() -> DataFrame:
        if order_delta is not None:
            return order_delta
        if late_by is None:
            return extract.orders_since(orders, marks["stg_dim_order"])
        since = str(event_mark - late_by)
        loaded = sinks.read_target_range(spark, root, "dim_order", "order_status_update_timestamp", since, except_batch=batch_id)
        return extract.orders_not_loaded(orders, since, loaded)

    concurrently([
        lambda: delta("delta_orders", new_orders()),
        lambda: delta("delta_customer", extract.customers_since(sources["customer_master"], marks["stg_dim_customer"])),
        lambda: delta("delta_products", extract.products_snapshot(sources["product_master"], marks["stg_dim_product"])),
    ])
    delta_orders, delta_customer, delta_products = (deltas[n] for n in DELTAS)
    if scd2:
        for name, changes in (("dim_product", delta_products), ("dim_customer", delta_customer)):
            known = _scd2_before(spark, root, name, batch_id, changes)
            existing[name] = known.where(F.col("end_date") == F.lit(tp.OPEN_END_DATE).cast("date"))
    if late_by is not None:
        n, latest = delta_orders.agg(F.count("*"), F.max("order_status_update_timestamp")).first()
        res.events = n, max(event_mark, min(latest or event_mark, run_ts))
    delta_items = extract.items_of(sources["order_items"], delta_orders)

    def product_stage():
        p_ins, p_upd = dims.product_delta(delta_products, existing["dim_product"], run_date)
        stage("dim_product", p_ins)
        res.product_updates = stage("dim_product_updates", p_upd)

    def reserve(n: int) -> int:
        return control.allocate(spark, sinks.ids_path(root, "dim_address"), batch_id, n, max_id(existing["dim_address"], "address_id"))

    def address_stage():
        if address_dedupe == "natural_key":
            matched = dims.match_addresses(delta_customer, existing["dim_address"])
            rows = dims.new_addresses(matched, reserve, sinks.stage_path(root, "address_ids", batch_id))
        else:
            rows = dims.address_delta(delta_customer, existing["dim_address"], address_dedupe, reserve)
        stage("dim_address", rows)

    def customer_stage():
        staged = sinks.read_stage(spark, root, "dim_address", batch_id)
        if address_dedupe == "natural_key":
            matched = dims.match_addresses(delta_customer, existing["dim_address"])
            c_ins, c_upd = dims.customers_from_matches(matched, staged, existing["dim_customer"])
        else:
            c_ins, c_upd = dims.customer_delta(delta_customer, existing["dim_customer"], existing["dim_address"].unionByName(staged))
        if scd2:
            c_upd = dims.rows_not_in(c_upd, existing["dim_customer"], dims.CUSTOMER_COMPARED)
        stage("dim_customer", c_ins)
        res.customer_updates = stage("dim_customer_updates", c_upd)

    def fact_stage():
        lines = sinks.read_stage(spark, root, "f_order_details", batch_id)
        fact = stage("fact_daily_orders", facts.daily_orders(delta_orders, delta_customer, delta_products, lines))
        stage("order_bits", distinct.order_bits(fact))

    concurrently([
        address_stage,
        lambda: stage("dim_order", dims.order_status_rows(delta_orders)),
        product_stage,
        lambda: stage("f_order_details", facts.order_lines(delta_orders, delta_items)),
    ])
    concurrently([fact_stage, customer_stage])
    return res


def load_targets(spark: SparkSession, root: str, batch_id: int) -> None:
    """Append every stage table to its target as batch ``batch_id`` (idempotent).
    Readers see the batch once ``log_completed`` has run."""
    again = batch_id in control.completed_ids(spark, sinks.log_path(root))
    concurrently([lambda n=name: sinks.load_target(spark, root, n, batch_id, again)
                   for name in (*schemas.TARGET_LOAD_ORDER, *schemas.STATES)])


def compact(spark: SparkSession, root: str, fanout: int = segments.FANOUT) -> dict[str, int]:
    """Merges small batch folders of every target (see ``segments``); returns merges per table."""
    merges: dict[str, int] = {}
    concurrently([lambda n=name: merges.__setitem__(n, segments.compact(spark, root, n, fanout))
                  for name in (*schemas.TARGET_LOAD_ORDER, *schemas.STATES)])
    return merges


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Deletes folders that compaction replaced; readers planned under the last ``keep`` + 1 pointers go on."""
    return [p for name in (*schemas.TARGET_LOAD_ORDER, *schemas.STATES) for p in segments.vacuum(spark, root, name, keep)]


def run_batch(spark: SparkSession, sources: dict[str, DataFrame], root: str,
              run_ts: dt.datetime, batch_id: int | None = None, **kw) -> BatchResult:
    res = extract_and_stage(spark, sources, root, run_ts, batch_id, **kw)
    load_targets(spark, root, res.batch_id)
    if kw.get("scd2"):
        apply_scd2(spark, root, res.batch_id)
    log_completed(spark, root, res)
    return res


def log_completed(spark: SparkSession, root: str, res: BatchResult) -> None:
    """One ``Completed`` log row per stage table of the batch: advances the marks
    and makes the batch's rows visible."""
    control.append_log_rows(spark, sinks.log_path(root), [
        (res.batch_id, schemas.STAGE_PREFIX + name, n, res.run_ts, control.COMPLETED)
        for name, n in res.staged.items()] + ([(res.batch_id, EVENTS, *res.events, control.COMPLETED)] if res.events else []))


def scd2_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Latest SCD2 version of a dimension by a completed batch; before the first apply, the
    append-loaded target (the union of its batches)."""
    return _scd2_before(spark, root, name, None)


def apply_scd2(spark: SparkSession, root: str, batch_id: int, buckets: int | None = None) -> dict[str, int]:
    """Write the SCD2 version of dim_product and dim_customer after a batch.

    Inserts and updates come from the batch's own stage folder. The open row
    of an updated key is closed where its new version starts, each update
    becomes an open row, inserts are added. Only the key buckets that hold a changed key are
    read and written (see ``versions``), on top of the latest version of a completed batch,
    whatever its id; nothing is written over, so a rerun of a completed batch gives its
    version new folders and leaves later versions as they are. The version counts once the
    batch is logged ``Completed``. ``buckets``: key buckets of the dimension, by default
    those that it has. Returns the rows written.
    """
    out: dict[str, int] = {}

    def apply(name: str, key: str) -> None:
        updates = sinks.read_stage(spark, root, f"{name}_updates", batch_id, UPDATES[f"{name}_updates"])
        if name == "dim_product":  # a product's new version starts on the run date
            updates = updates.withColumnRenamed("end_date", "start_date")
        inserts = sinks.read_stage(spark, root, name, batch_id)
        done = _versions(spark, root, name)
        number = done.get(batch_id) or max(done.values(), default=0) + 1
        older = _older(done, batch_id)
        kept = versions.layout(spark, root, name, older) if older else None
        n = buckets or (kept.buckets if kept else versions.BUCKETS)
        if kept and kept.buckets == n:
            changed = versions.touched(inserts.select(key).unionByName(updates.select(key)), key, n)
            before = versions.read(spark, root, name, older, changed)
        else:  # the first version, or another number of buckets: every bucket is written
            kept, before = None, _scd2_before(spark, root, name, batch_id)
        new = dims.scd2_apply(schemas.conform(before, schemas.TARGETS[name].schema), inserts, updates, key)
        out[name] = versions.write(spark, root, name, key, (number, batch_id), new, kept, n)

    concurrently([lambda n=name, k=key: apply(n, k) for name, key in SCD2_KEYS.items()])
    return out


def vacuum_scd2(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes all but the last ``keep`` versions of completed batches, and the bucket folders
    that only older ones or failed attempts name; run it while no batch runs."""
    gone = []
    for name in SCD2_KEYS:
        last = sorted(((v, b) for b, v in _versions(spark, root, name).items()), reverse=True)[:keep]
        gone += versions.vacuum(spark, root, name, last) if last else []
    return gone


def _versions(spark: SparkSession, root: str, name: str) -> dict[int, int]:
    """Number of the version of each completed batch that has one. A version whose batch failed
    after it was written doesn't count."""
    done = set(control.completed_ids(spark, sinks.log_path(root)))
    return {batch: number for number, batch in versions.found(spark, root, name) if batch in done}


def _older(done: dict[int, int], batch_id: int | None) -> tuple[int, int] | None:
    """(number, batch) of the latest version that ``batch_id`` builds on."""
    last = done.get(batch_id, max(done.values(), default=0) + 1)
    return max(((v, b) for b, v in done.items() if v < last), default=None)


def _scd2_before(spark: SparkSession, root: str, name: str, batch_id: int | None, changes: DataFrame | None = None) -> DataFrame:
    """Latest version that ``batch_id`` builds on; without one, the append-loaded
    target of the other batches. ``changes``: only the key buckets that hold one of its keys
    are needed (the rows of others may be left out)."""
    older = _older(_versions(spark, root, name), batch_id)
    if older is None:
        return sinks.read_target(spark, root, name, except_batch=batch_id)
    known = versions.layout(spark, root, name, older) if changes is not None else None
    only = versions.touched(changes, SCD2_KEYS[name], known.buckets) if known else None
    return versions.read(spark, root, name, older, only)


def warehouse(spark: SparkSession, root: str, accumulate: bool = False) -> StarSchema:
    """The loaded star schema (all completed batches) for the analytics questions.

    ``accumulate``: order facts and lines show what later batches loaded about the same
    order (see ``facts.accumulated_orders``); without it, what their own batch knew."""
    star = StarSchema(**{n: sinks.read_target(spark, root, n) for n in schemas.TARGET_LOAD_ORDER})
    # read last: a batch completed meanwhile only adds to the state, which keeps counts exact
    star.order_bits = sinks.read_state(spark, root, "order_bits")
    if accumulate:
        star.fact_daily_orders = facts.accumulated_orders(star.fact_daily_orders, star.dim_order)
        star.f_order_details = facts.accumulated_lines(star.f_order_details, star.dim_order)
    return star
