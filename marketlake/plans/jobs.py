"""Jobs: backfill over a run-date range (BKF-1), the monthly reference load
(LOD-1) and the daily warehouse load (flow B).

The compute functions (``reference_load``, ``warehouse_increment``) take and
return DataFrames, so they are testable without storage.  The ``run_*``
functions wire them to storage: landed JSON in, versioned snapshots (reference
tables) and append-only parquet (warehouse) out.  Between steps the written
tables are re-read, which also cuts the lineage — a lost executor recomputes
from the last written table, not from the landing files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .. import schemas
from ..functions.temporal import epoch_ms_to_ts, published_day
from ..operators.hot import split_join
from ..operators.keys import ID_MAP, assign_dense_ids, latest_per_key, max_id, resolve_fks, settle_ids
from ..operators.merge import duplicate_count, insert_ignore, upsert
from ..operators.quality import check_fk, check_unique, profile
from ..operators.sets import assemble_capped, capped_report
from ..session import materialise, scratch_scope
from ..sinks.publish import Load, is_published, read_published
from ..sinks.writers import read_snapshot, write_json, write_snapshots
from ..sources.landing import (empty_frame, read_bars_range, read_bodies_range, read_landing,
                               read_landing_range, run_date_filter, run_dates_between, unwrap_envelope)
from ..storage import is_missing_path
from . import dims, facts, normalize


def first_occurrence(df: DataFrame, keys: list[str], run_dates, run_date_col: str = "run_date",
                     tie_break: list[str] | None = None) -> DataFrame:
    """BKF-1: what repeated daily insert-only runs over ``run_dates`` leave
    behind — the earliest run date's row per key — computed in ONE job over
    all the partitions of the range instead of a loop of daily jobs.

    ``run_dates`` is a date, an inclusive ``(start, end)`` tuple or a list;
    the filter is on the run-date (partition) column, so a lake table is
    pruned to the range."""
    rows = df.where(run_date_filter(run_date_col, run_dates))
    return latest_per_key(rows, keys, [run_date_col] + list(tie_break or []), descending=False)


# ---------------------------------------------------------------------------
# LOD-1: monthly reference load
# ---------------------------------------------------------------------------

# fixed values: columns of the reference tables
REF_SCHEMAS = {
    "regions": "id long, region string, local_open string, local_close string, "
               "updated_time timestamp_ntz, hash_row string",
    "exchanges": "id long, region_id long, name string, updated_time timestamp_ntz, "
                 "hash_row string",
    "industries": "id long, industry string, sector string",
    "sic_industries": "id long, sic_industry string, sic_sector string",
    "companies": "id long, exchange_id long, industry_id long, sic_id long, name string, "
                 "ticker string, is_delisted boolean, category string, currency string, "
                 "location string, updated_time timestamp_ntz, hash_row string",
}


def _fill_ids(df: DataFrame, order_by: list[str], start: int, id_col: str = "id") -> DataFrame:
    """Keep existing ids; give rows without one dense ids after ``start``.

    The merge is written once and read by every later step; only the new
    keys are numbered, the other rows are not touched again."""
    merged = materialise(df, "merged")
    new = merged.where(F.col(id_col).isNull()).drop(id_col)
    if new.isEmpty():                  # no new key this run (the usual month)
        return merged
    have = merged.where(F.col(id_col).isNotNull())
    return have.unionByName(assign_dense_ids(new, order_by, start=start, id_col=id_col))


def _upsert_table(current: DataFrame, batch: DataFrame, keys, cols, run_ts, hash_mode):
    # the drop has no order of its own: among duplicates of a key the largest row, by all
    # columns, wins, whatever order the rows came in
    merged = upsert(current, batch, keys, cols, order_by=None, run_ts=run_ts,
                    hash_mode=hash_mode)
    return _fill_ids(merged, keys, start=max_id(current))


def reference_load(current: dict[str, DataFrame], normalised: dict[str, DataFrame], run_ts,
                   hash_mode: str = "json"):
    """LOD-1: regions → exchanges(region_id) → industries → sic → companies
    (three foreign keys), in foreign-key order.

    Returns ``(tables, quarantine, report)``: the next version of each table
    (with an ``action`` column: inserted/updated/unchanged/kept), the rows
    whose foreign key did not resolve (with ``table`` and ``reason``), and
    the affected-row counts per table and action (DQ-6; ``duplicate`` counts
    the rows that lost to another row of their key).  Unresolved rows are
    quarantined; every other row still loads (the intent of the "skipping"
    messages, without the all-or-nothing rollback)."""
    out, bad = {}, []

    regions = _upsert_table(current["regions"], normalised["regions"], ["region"],
                            ["local_open", "local_close"], run_ts, hash_mode)
    out["regions"] = regions

    ex, ex_missed = resolve_fks(normalised["exchanges"],
                                [(regions.select("id", "region"), ["region"], "region_id")])
    bad.append(ex_missed.select(F.lit("exchanges").alias("table"),
                                F.to_json(F.struct(*normalised["exchanges"].columns)).alias("row"),
                                "reason"))
    out["exchanges"] = _upsert_table(current["exchanges"], ex.select("name", "region_id"),
                                     ["name"], ["region_id"], run_ts, hash_mode)

    for name, keys in (("industries", ["industry", "sector"]),
                       ("sic_industries", ["sic_industry", "sic_sector"])):
        batch = normalised[name].select(*keys)
        merged = insert_ignore(current[name], batch.withColumn("id", F.lit(None).cast("long")),
                               keys)
        merged = merged.withColumn("action", F.when(F.col("inserted"), F.lit("inserted"))
                                   .otherwise(F.lit("kept"))).drop("inserted")
        out[name] = _fill_ids(merged, keys, start=max_id(current[name]))

    comp = normalised["companies"]
    c3, missed = resolve_fks(comp, [
        (out["exchanges"], {"exchange": "name"}, "exchange_id"),
        (out["industries"], ["industry", "sector"], "industry_id"),
        (out["sic_industries"], ["sic_industry", "sic_sector"], "sic_id")])
    bad.append(missed.select(F.lit("companies").alias("table"),
                             F.to_json(F.struct(*comp.columns)).alias("row"), "reason"))
    cols = ["exchange_id", "industry_id", "sic_id", "name", "category", "currency", "location"]
    out["companies"] = _upsert_table(current["companies"], c3, ["ticker", "is_delisted"], cols,
                                     run_ts, hash_mode)

    quarantine = reduce(lambda a, b: a.unionByName(b), bad)
    keys = {"regions": (normalised["regions"], ["region"]), "exchanges": (ex, ["name"]),
            "companies": (c3, ["ticker", "is_delisted"])}
    report = reduce(lambda a, b: a.unionByName(b), [
        *[t.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))
          .select(F.lit(n).alias("table"), "action", "rows") for n, t in out.items()],
        *[duplicate_count(batch, k).where("rows > 0")
          .select(F.lit(n).alias("table"), F.lit("duplicate").alias("action"), "rows")
          for n, (batch, k) in keys.items()]])
    return out, quarantine, report


def run_reference_load(spark: SparkSession, landing: str, root: str, run_date: str, run_ts,
                       hash_mode: str = "json"):
    """Monthly flow A end to end: landed ``markets`` / ``companies`` drops of
    ``run_date`` → normalise → load in FK order → a new snapshot per table.

    A missing or malformed drop is an error.  The normalised tables of the run
    date are written first (``{root}/_normalised/{name}/run_date=…``, JSON
    lines) and read back, so the landed JSON is parsed once; the five tables,
    the quarantine and the report become visible in one commit.
    Returns (quarantine, report) read back from what was written."""
    markets = read_landing(spark, f"{landing}/markets", run_date, schemas.MARKETS)
    companies_raw = read_landing(spark, f"{landing}/companies", run_date, schemas.COMPANIES_RAW)
    normalised = {}
    for name, df in normalize.normalise_all(markets, companies_raw).items():
        path = f"{root.rstrip('/')}/_normalised/{name}/run_date={run_date}"
        write_json(df, path)
        normalised[name] = spark.read.schema(df.schema).json(path)
    current = {}
    for name, ddl in REF_SCHEMAS.items():
        snap = read_snapshot(spark, root, name)
        current[name] = snap if snap is not None else spark.createDataFrame([], ddl)
        current[name] = current[name].drop("action")
    order = ("regions", "exchanges", "industries", "sic_industries", "companies")
    with scratch_scope(spark):
        tables, quarantine, report = reference_load(current, normalised, run_ts, hash_mode)
        write_snapshots(spark, {**{name: tables[name] for name in order}, "quarantine": quarantine, "load_report": report}, root)
    return read_snapshot(spark, root, "quarantine"), read_snapshot(spark, root, "load_report")


# ---------------------------------------------------------------------------
# flow B: daily warehouse load
# ---------------------------------------------------------------------------

WAREHOUSE_DDL = schemas.WAREHOUSE_DDL

# facts are partitioned by day (candles: trading day; news and its bridges:
# publication day) so an insert-if-new load reads only the days it touches
# and a re-run of a day never scans history
PARTITIONS = {"fact_candles": "time_id", "dim_news": "published_day",
              "fact_news_topics": "published_day", "fact_news_companies": "published_day"}


def read_warehouse(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table as of the newest commit (or a plain folder, where there is no commit log)."""
    if is_published(spark, root):
        return read_published(spark, root, name, WAREHOUSE_DDL[name])
    path = f"{root.rstrip('/')}/{name}"
    try:
        return spark.read.schema(WAREHOUSE_DDL[name]).parquet(path)
    except AnalysisException as exc:
        if not is_missing_path(exc):  # anything else must not pass for an empty warehouse
            raise
        return empty_frame(spark, WAREHOUSE_DDL[name])


def new_dimension_rows(wh: dict[str, DataFrame], extract: DataFrame, news: DataFrame,
                       bars: DataFrame, run_date) -> dict[str, DataFrame]:
    """DIM-2..DIM-5: the rows to append to each dimension for one run."""
    dates = (bars.select(epoch_ms_to_ts("time_stamp").cast("date").alias("date"))
             .unionByName(extract.sparkSession.range(1).select(
                 F.lit(run_date).cast("date").alias("date"))))
    return {
        "dim_companies": dims.new_companies(wh["dim_companies"], extract),
        "dim_time": dims.new_dates(wh["dim_time"], dates),
        "dim_topics": dims.new_topics(wh["dim_topics"], news),
        "dim_news": dims.new_news(wh["dim_news"], news, run_date),
    }


def new_fact_rows(wh: dict[str, DataFrame], news: DataFrame, bars: DataFrame, run_date=None,
                  id_map: DataFrame | None = None, split_hot: bool = False) -> dict[str, DataFrame]:
    """FCT-1..FCT-3: the rows to append to each fact, given dimensions that
    already include this run's new rows."""
    return {
        "fact_candles": facts.new_candles(wh["fact_candles"], bars, wh["dim_companies"],
                                          run_date, split_hot=split_hot),
        "fact_news_topics": facts.new_topic_links(wh["fact_news_topics"], news, wh["dim_topics"],
                                                  wh["dim_news"], id_map=id_map),
        "fact_news_companies": facts.new_company_links(wh["fact_news_companies"], news, wh["dim_companies"],
                                                       wh["dim_news"], id_map=id_map, split_hot=split_hot),
    }


def capped_news(spark: SparkSession, landing: str, run_dates: list[str], cap: int):
    """SRC-7 + SET-2: the raw news responses ``{landing}/news/{name}-{zone}-{YYYYMMDD}.json`` of the run dates,
    in one scan (zone 1 the full day, 2 and 3 its halves; the array under the required key ``feed``).

    Returns ``(articles, incomplete days, quarantine)``, all with their ``run_date``; a malformed response
    or one without the key is quarantined with its zone."""
    bodies = read_bodies_range(spark, f"{landing}/news", run_dates, "*-[123]")
    zone = F.regexp_extract("path", r"-(\d)-\d{8}\.json(?:/[^/]*)?$", 1).cast("int")
    items = materialise(unwrap_envelope(bodies.select("run_date", zone.alias("zone"), "body"), "body", "feed", schemas.NEWS_RAW), "news-zones")
    bad = items.where("_envelope_error").select(
        F.lit("news").alias("source"), F.lit("malformed response or no feed").alias("reason"),
        F.to_json(F.struct("run_date", "zone")).alias("row"), "run_date")
    good = items.where("NOT _envelope_error").drop("_envelope_error")
    kept = assemble_capped(good, cap).select(*[f.name for f in schemas.NEWS_RAW.fields], "run_date")
    return kept, capped_report(good, cap), bad


#: Shapes of the run-date tables of the lake.
LAKE_DDL = {name: T.StructType(shape.fields + [T.StructField("run_date", T.DateType())])
            for name, shape in (("news", schemas.NEWS_RAW), ("ohlcs", schemas.OHLC))}


class _Lake:
    """The run-date lake of a load: part of the warehouse's own commit, or a root with commits of its own."""

    def __init__(self, load: Load, lake: str | None):
        self.load = load if lake is None else Load(load.spark, lake)
        self.prefix, self.own = ("_lake/", False) if lake is None else ("", True)

    def replace(self, name: str, df: DataFrame, run_dates: list[str]) -> None:
        self.load.replace(self.prefix + name, df, run_dates)

    def read(self, name: str, run_dates: list[str]) -> DataFrame:
        return self.load.read(self.prefix + name, LAKE_DDL[name], partitions=run_dates)

    def commit(self) -> None:
        if self.own:
            self.load.commit()


def ingest(spark: SparkSession, landing: str, lake: _Lake, run_dates: list[str], news_cap: int | None = None) -> None:
    """SRC-2 → SNK-2: convert the landed JSON (news, bars) of the run dates once into the parquet lake.

    One scan per source, each row tagged with the run date of its file name; after this hop every read is
    a columnar scan of the run dates' own folders.  A re-run replaces the run dates, also where a drop is now missing or
    empty.  Without ``news_cap`` the news are arrays of articles, and a raw response among them is an error; with it
    they are the raw capped responses of :func:`capped_news`: days they may not cover go to ``news_incomplete``,
    bad responses to ``news_bad``."""
    if news_cap is None:
        news = read_landing_range(spark, f"{landing}/news", run_dates, schemas.NEWS_RAW)
    else:
        news, incomplete, bad = capped_news(spark, landing, run_dates, news_cap)
        lake.replace("news_incomplete", incomplete, run_dates)
        lake.replace("news_bad", bad, run_dates)
    lake.replace("news", news, run_dates)
    lake.replace("ohlcs", read_bars_range(spark, f"{landing}/ohlcs", run_dates), run_dates)


def daily_quarantine(news: DataFrame, bars: DataFrame, dim_companies: DataFrame,
                     run_date, split_hot: bool = False) -> DataFrame:
    """DQ-5 for flow B: the landed rows a daily load leaves out, with why.

    Articles whose key (title, url, time_published) has a null part or whose
    publication time does not parse; bars without a weighted price (FLT-5),
    with a volume no long can hold, or whose ticker is not a company.  One
    row per left-out input row: ``(run_date, source, reason, row)`` with the
    row as JSON text.  ``run_date`` is a day, or a column of both inputs."""
    day = dims.as_date(run_date).alias("run_date")
    key_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in dims.NEWS_KEY])
    bad_time = published_day("time_published").isNull()
    news_bad = news.where(key_null | bad_time).select(
        F.lit("news").alias("source"),
        F.when(key_null, F.lit("null title/url/time_published"))
        .otherwise(F.lit("unparseable time_published")).alias("reason"),
        F.to_json(F.struct(*news.columns)).alias("row"), day)
    tickers = dim_companies.select("ticker").distinct()
    join = split_join if split_hot else DataFrame.join
    unknown = join(bars, tickers, ["ticker"], "left_anti").select(
        F.lit("ohlcs").alias("source"), F.lit("unknown ticker").alias("reason"),
        F.to_json(F.struct(*bars.columns)).alias("row"), day)
    no_vw = join(bars, tickers, ["ticker"], "left_semi").where(
        F.col("volume_weighted").isNull() | ~facts.storable_volume()).select(
        F.lit("ohlcs").alias("source"),
        F.when(F.col("volume_weighted").isNull(), F.lit("null volume_weighted"))
        .otherwise(F.lit("volume out of range")).alias("reason"),
        F.to_json(F.struct(*bars.columns)).alias("row"), day)
    return news_bad.unionByName(unknown).unionByName(no_vw)


def _extract(spark: SparkSession, ref_root: str, as_of=None) -> DataFrame:
    """DIM-1 over the reference snapshots of the newest commit."""
    ref = {n: read_snapshot(spark, ref_root, n) for n in REF_SCHEMAS}
    return dims.company_extract(ref["companies"], ref["exchanges"], ref["regions"],
                                ref["industries"], ref["sic_industries"], as_of=as_of)


def _tables(load: Load) -> dict[str, DataFrame]:
    return {n: load.read(n, schema) for n, schema in WAREHOUSE_DDL.items()}


def run_daily_load(spark: SparkSession, landing: str, ref_root: str, root: str, run_date: str,
                   lake: str | None = None, extract_as_of=None, news_cap: int | None = None, split_hot: bool = False):
    """Daily flow B end to end for one run date.

    The landed news and bars of ``run_date`` are first converted into the
    parquet lake (``lake``, default ``_lake`` below the warehouse); a missing drop is an
    empty day.  The reference snapshots give the company extract (DIM-1;
    ``extract_as_of`` keeps only companies changed on that day, default:
    every current company — dim_companies is insert-new by ticker, so the
    superset is safe).  The dimensions are written first and re-read, then
    the facts; every step is insert-if-new, so running a day twice changes
    nothing.  Rows left out go to ``_quarantine`` with a
    reason.  All of it becomes visible in one commit.  ``split_hot`` keeps the rows of hot tickers out of
    the joins' shuffles (:func:`operators.split_join`).  Returns the number of rows appended per table (observed during the writes)."""
    with scratch_scope(spark):
        load = Load(spark, root)
        store = _Lake(load, lake)
        ingest(spark, landing, store, [run_date], news_cap)
        news, bars = store.read("news", [run_date]).drop("run_date"), store.read("ohlcs", [run_date]).drop("run_date")
        extract = _extract(spark, ref_root, extract_as_of)
        added = {}
        for name, rows in new_dimension_rows(_tables(load), extract, news, bars, run_date).items():
            added[name] = _append(load, rows, name)
        wh = _tables(load)
        for name, rows in new_fact_rows(wh, news, bars, run_date, _id_map(load), split_hot).items():
            added[name] = _append(load, rows, name)
        bad = daily_quarantine(news, bars, wh["dim_companies"], run_date, split_hot)
        added["quarantine"] = load.replace("_quarantine", bad, [run_date])
        store.commit()
        load.commit()
        load.clean()
    return added


def run_backfill(spark: SparkSession, landing: str, ref_root: str, root: str, start: str,
                 end: str, lake: str | None = None, news_cap: int | None = None, chunk_days: int | None = None, split_hot: bool = False):
    """BKF-1: load a whole range of run dates (inclusive) as ONE set of jobs, or one per ``chunk_days`` days.

    The result equals running :func:`run_daily_load` for every day of the
    range in order (with the same ``news_cap``): every insert-if-new keeps a key's *earliest* run date
    (a news row's ``time_id`` is the run date it first appeared; a bridge
    row keeps its first scores), dim_topics ids follow (first run date,
    name), and candles take their own run date's ``time_id``.  One scan per
    source over all run dates of a chunk replaces a loop of daily jobs.

    Every chunk is a commit, which also notes that the chunk is done: a backfill that was
    broken off goes on behind its last commit when it is called again with the same range, chunks
    and cap; the last commit of a range removes the notes, so that a finished one can be run anew.
    ``split_hot`` as in :func:`run_daily_load`."""
    days = run_dates_between(start, end)
    step = chunk_days or max(1, len(days))
    chunks = [days[i:i + step] for i in range(0, len(days), step)]
    key = f"backfill {start} {end} {step} {news_cap}"
    load = Load(spark, root)
    added: dict[str, int] = {}
    for chunk in chunks:
        if chunk[0] in load.notes(key):
            continue
        with scratch_scope(spark):
            done = _backfill_chunk(load, landing, ref_root, chunk, lake, news_cap, split_hot)
        for name, rows in done.items():
            added[name] = added.get(name, 0) + rows
        load.note(key, chunk[0])
        if chunk is chunks[-1]:
            load.forget(key)
        load.commit()
        load.clean()
    return added


def _backfill_chunk(load: Load, landing: str, ref_root: str, run_dates: list[str], lake: str | None, news_cap: int | None, split_hot: bool) -> dict[str, int]:
    """The rows that daily loads of ``run_dates`` would add, written but not yet committed."""
    spark = load.spark
    store = _Lake(load, lake)
    ingest(spark, landing, store, run_dates, news_cap)
    news, bars = store.read("news", run_dates), store.read("ohlcs", run_dates)
    extract = _extract(spark, ref_root)
    wh = _tables(load)
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(run_dates[0]).cast("date"), F.lit(run_dates[-1]).cast("date"))).alias("date"))
    dates = bars.select(epoch_ms_to_ts("time_stamp").cast("date").alias("date")).unionByName(days)
    new_dims = {
        "dim_companies": dims.new_companies(wh["dim_companies"], extract),
        "dim_time": dims.new_dates(wh["dim_time"], dates),
        "dim_topics": dims.new_topics(wh["dim_topics"], news, first_by="run_date"),
        "dim_news": dims.new_news(wh["dim_news"], news, F.col("run_date")),
    }
    added = {name: _append(load, rows, name) for name, rows in new_dims.items()}
    wh, id_map = _tables(load), _id_map(load)
    new_facts = {
        "fact_candles": facts.new_candles(
            wh["fact_candles"], bars, wh["dim_companies"], F.col("run_date"),
            days=[int(d.replace("-", "")) for d in run_dates], split_hot=split_hot),
        "fact_news_topics": facts.new_topic_links(wh["fact_news_topics"], news,
                                                  wh["dim_topics"], wh["dim_news"],
                                                  first_by="run_date", id_map=id_map),
        "fact_news_companies": facts.new_company_links(wh["fact_news_companies"], news,
                                                       wh["dim_companies"], wh["dim_news"],
                                                       first_by="run_date", id_map=id_map, split_hot=split_hot),
    }
    added.update({name: _append(load, rows, name) for name, rows in new_facts.items()})
    bad = daily_quarantine(news, bars, wh["dim_companies"], F.col("run_date"), split_hot)
    added["quarantine"] = load.replace("_quarantine", bad, run_dates)
    store.commit()
    return added


#: Natural keys of the tables whose ids are hashes of their day and key.
HASH_KEYS = {"dim_news": dims.NEWS_KEY, "fact_candles": ["company_id", "time_id"],
             "fact_news_topics": ["new_id", "topic_id"], "fact_news_companies": ["new_id", "company_id"]}


def _id_map(load: Load) -> DataFrame | None:
    """Keys whose id is not their hash (None, without a job, if there are none)."""
    if not load.rows("_id_map"):
        return None
    return load.read("_id_map", T.StructType.fromDDL(ID_MAP))


def _append(load: Load, rows: DataFrame, name: str) -> int:
    """SNK-4 append; the row count is observed during the write (DQ-6), not
    computed by a second pass.  Rows with hash ids are written to scratch first
    and their ids settled (KEY-1)."""
    cols = [f.name for f in WAREHOUSE_DDL[name].fields]
    rows = rows.select(*cols)
    if name in HASH_KEYS:
        rows = materialise(rows, f"append-{name}")
        stored = load.read(name, WAREHOUSE_DDL[name])
        rows, moved = settle_ids(rows, stored, HASH_KEYS[name], PARTITIONS[name], name)
        if moved is not None:
            load.append("_id_map", moved)
    return load.append(name, rows.select(*cols), partition_by=PARTITIONS.get(name))


class HashIdCollision(RuntimeError):
    """Two different keys have one hash id."""


def check_hash_ids(rows: DataFrame, stored: DataFrame, partition: str) -> None:
    """KEY-1: raise if new rows share a hash id with one another or with stored rows of
    their partition values (those partitions only are read)."""
    days = F.broadcast(rows.select(partition).distinct())  # one a calendar day
    old = stored.select(partition, "id").join(days, partition, "left_semi")
    both = rows.select(partition, "id").unionByName(old)
    twice = both.groupBy(partition, "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise HashIdCollision(f"hash ids meet: {twice.first()['id']}")


def warehouse_quality(wh: dict[str, DataFrame], days: list[int] | None = None) -> DataFrame:
    """DQ-1..DQ-4 over the whole warehouse as ONE report DataFrame
    ``(table, check, column_name, violations)``: NOT NULL and text widths
    (one scan per table), id uniqueness, and every foreign key of the DDL
    between the tables given.  Nothing is collected; the caller writes or shows the report.

    With ``days`` (yyyymmdd) the check covers what loads of those days touched: of the day-partitioned
    tables only these partitions are read, as children and as parents.  Nothing is missed by that, for
    ids hold their day, so equal ids lie in one partition, and a bridge row lies in its article's; the counts of
    disjoint sets of days add up to those of the full check (a bridge row outside its article's day is reported
    by the check of days alone)."""
    if days is not None:
        wh = {n: df.where(F.col(PARTITIONS[n]).isin(days)) if n in PARTITIONS else df for n, df in wh.items()}
    parts = []
    for name, df in wh.items():
        nn, widths = schemas.NOT_NULL.get(name, []), schemas.MAX_LENGTH.get(name, {})
        if nn or widths:
            parts.append(profile(df, nn, widths).select(F.lit(name).alias("table"), "*"))
        parts.append(check_unique(df, ["id"]).agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("table"), F.lit("unique").alias("check"),
                             F.lit("id").alias("column_name"), "violations"))
    for child, col, parent in schemas.FOREIGN_KEYS:
        if child not in wh or parent not in wh:
            continue
        bad = check_fk(wh[child], wh[parent], {col: "id"})
        parts.append(bad.agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(child).alias("table"), F.lit(f"fk->{parent}").alias("check"),
                             F.lit(col).alias("column_name"), "violations"))
    return reduce(lambda a, b: a.unionByName(b), parts)
