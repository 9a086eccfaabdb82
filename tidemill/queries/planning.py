"""Chunk planning, hierarchies, catalogue joins and the queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.idents import matches, qualified
from tidemill.functions.times import CHUNK, chunk_start, space_slice
from tidemill.plans import catalog, planner, taskqueue
from tidemill.queries.base import CTE, INT_WIDTH, TREE, YEAR, chunks, dimensions, hypertables, query, rollups, stored, table, tree

UNTIL, FROM = "2024-01-24 12:00:00", "2024-01-05 06:00:00"
US_UNTIL, US_FROM = 1706097600000000, 1704434400000000
NAMED = """CASE WHEN regexp_matches({0}, '^[a-z_][a-z0-9_$]*$') THEN {0} ELSE '"' || {0} || '"' END"""
FULL = f"{NAMED.format('schema_name')} || '.' || {NAMED.format('table_name')}"


def _plan_sql(until: str, us_until: str, frm: str | None, us_from: str, types: str, quote: str) -> str:
    q = "'''" if quote else ""
    lit = lambda v: f"{q} || '{v}' || {q}" if quote else f"'{v}'"
    below = f"CASE WHEN range_start <= {us_from} AND {us_from} < range_end THEN col || ' >= ' || {lit(frm)} END" if frm else "NULL"
    low = f"AND {us_from} < range_end" if frm else ""
    return f"""SELECT hypertable, chunk_id, range_start, range_end, nullif(concat_ws(' and ',
            CASE WHEN range_start < {us_until} AND {us_until} < range_end THEN col || ' < ' || {lit(until)} END, {below}), '') AS "filter"
        FROM (SELECT {FULL} AS hypertable, chunk_id, range_start, range_end, dropped,
                     CASE WHEN d.column_name IN ('time') THEN '"time"' ELSE d.column_name END AS col, d.column_type
              FROM chunks c JOIN ht h ON h.id = c.hypertable_id JOIN dim d ON d.hypertable_id = h.id
              WHERE d.id = (SELECT min(id) FROM dim e WHERE e.hypertable_id = h.id)) p
        WHERE NOT dropped AND range_start < {us_until} {low} AND column_type IN ({types})"""


TIME_PLAN = _plan_sql(UNTIL, str(US_UNTIL), FROM, str(US_FROM), "'timestamp'", "y").replace("'''", "''''")
#: Everything before the bound: events and orders.
OPEN_PLAN = _plan_sql(UNTIL, str(US_UNTIL), None, "", "'timestamp'", "y").replace("'''", "''''")
#: An interval that cuts two chunks of orders.
O_UNTIL, O_FROM = "1999-06-15 00:00:00", "1996-02-03 04:05:06"
ORDERS_PLAN = _plan_sql(O_UNTIL, "929404800000000", O_FROM, "823320306000000", "'timestamp'", "y").replace("'''", "''''")
INT_PLAN = _plan_sql("5500", "5500", None, "", "'bigint'", "y").replace("'''", "''''")


def _plan(spark, sf_dir, until, frm=None, drop=True):
    return planner.plan_chunks(chunks(spark, sf_dir, drop), hypertables(spark), dimensions(spark), until, frm)


@query(f"WITH {CTE} {TIME_PLAN}")
def plan_chunks(spark, sf_dir):
    return _plan(spark, sf_dir, UNTIL, FROM)


@query(f"WITH {CTE} {ORDERS_PLAN}")
def plan_residual_filter(spark, sf_dir):
    return _plan(spark, sf_dir, O_UNTIL, O_FROM)


@query(f"WITH {CTE} SELECT {FULL} AS hypertable, chunk_id FROM chunks c JOIN ht h ON h.id = c.hypertable_id WHERE NOT dropped AND h.id IN (1, 2)")
def plan_skips_dropped(spark, sf_dir):
    """A plan up to a bound after all data: every chunk of the timed tables but those dropped."""
    return _plan(spark, sf_dir, "2100-01-01").select("hypertable", "chunk_id")


@query(f"WITH {CTE} {INT_PLAN}")
def plan_int_dimension(spark, sf_dir):
    """A number as bound: only integer tables can be compared with it."""
    return _plan(spark, sf_dir, "5500").filter(F.col("hypertable").startswith("other"))


@query(f"SELECT c_custkey, {FULL} AS name FROM (SELECT c_custkey, lower(c_mktsegment) AS schema_name, c_name AS table_name FROM customer) WHERE regexp_matches({FULL}, '(^build.*#[0-9]+7\"$|^machinery\\..*)', 'i')")
def filter_tables(spark, sf_dir):
    """Tables named by the customers, by a pattern over their qualified names; names that need it are quoted."""
    name = qualified(F.lower("c_mktsegment"), F.col("c_name"))
    return table(spark, sf_dir, "customer").filter(matches(name, r'(^BUILD.*#[[:digit:]]+7"$|^machinery\..*)')).select("c_custkey", name.alias("name"))


#: Rollups of one nation's customers whose number ends in 7.
_PATTERN = "^n7[.]c[[:digit:]]*7$"
_START = "SELECT mat_id AS id FROM tree WHERE regexp_matches(view_schema || '.' || view_name, '^n7[.]c[0-9]*7$')"


def _walk(up: bool, down: bool) -> str:
    parts = [f"SELECT id FROM ({_START})"]
    for wanted, own, other in ((up, "raw_id", "mat_id"), (down, "mat_id", "raw_id")):
        if wanted:
            parts.append(f"(WITH RECURSIVE w(id) AS (SELECT id FROM ({_START}) UNION SELECT r.{other} FROM w JOIN tree r ON r.{own} = w.id) SELECT id FROM w)")
    return f"WITH {TREE} SELECT DISTINCT id FROM ({' UNION ALL '.join(parts)})"


def _cascade(spark, sf_dir, up, down):
    own = tree(spark, sf_dir)
    return planner.closure(planner.seeds(stored(spark, sf_dir), own, _PATTERN), own, up, down)


@query(_walk(True, False))
def cascade_up(spark, sf_dir):
    """Rollups of a pattern and all that are built on them, in a hierarchy as large as the customers."""
    return _cascade(spark, sf_dir, True, False)


@query(_walk(False, True))
def cascade_down(spark, sf_dir):
    return _cascade(spark, sf_dir, False, True)


@query(_walk(True, True))
def cascade_both(spark, sf_dir):
    return _cascade(spark, sf_dir, True, True)


@query(f"""WITH RECURSIVE {TREE}, walk(mat_id, view_schema, view_name, lvl) AS (SELECT mat_id, view_schema, view_name, 0 FROM tree WHERE raw_id NOT IN (SELECT mat_id FROM tree)
    UNION ALL SELECT r.mat_id, r.view_schema, r.view_name, w.lvl + 1 FROM walk w JOIN tree r ON r.raw_id = w.mat_id) SELECT * FROM walk""")
def cagg_levels(spark, sf_dir):
    return planner.levels(tree(spark, sf_dir))


@query("SELECT event_id AS id, user_id AS hypertable_id, event_type AS column_name FROM events e WHERE user_id IS NOT NULL AND event_id = (SELECT min(event_id) FROM events x WHERE x.user_id = e.user_id)")
def first_dimension(spark, sf_dir):
    """The entry of least id of each table, where users stand for tables and their events for dimensions."""
    rows = table(spark, sf_dir, "events").filter("user_id is not null")
    return catalog.first_dimension(rows.select(F.col("event_id").alias("id"), F.col("user_id").alias("hypertable_id"), F.col("event_type").alias("column_name")))


@query(f"WITH {CTE} SELECT hypertable_id, chunk_id FROM chunks WHERE range_start < {US_UNTIL} AND range_end > {US_FROM}")
def range_overlap(spark, sf_dir):
    return planner.overlapping(chunks(spark, sf_dir), US_FROM, US_UNTIL).select("hypertable_id", "chunk_id")


@query(f"SELECT floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK} AS range_start, floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK} + {CHUNK} AS range_end, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def chunk_assign_time(spark, sf_dir):
    start = chunk_start(F.col("ts")).alias("range_start")
    return table(spark, sf_dir, "events").filter("ts is not null").groupBy(start).agg(F.count("*").alias("n")).select("range_start", (F.col("range_start") + CHUNK).alias("range_end"), "n")


@query(f"SELECT o_orderkey // {INT_WIDTH} * {INT_WIDTH} AS range_start, count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1")
def chunk_assign_int(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderkey is not null").groupBy(chunk_start(F.col("o_orderkey"), "bigint", INT_WIDTH).alias("range_start")).agg(F.count("*").alias("n"))


@query(f"SELECT floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK} AS range_start, user_id % 4 AS slice, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def chunk_assign_space(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("ts is not null").groupBy(chunk_start(F.col("ts")).alias("range_start"), space_slice(F.col("user_id"), 4).alias("slice")).agg(F.count("*").alias("n"))


def _slices(spark, sf_dir, keep):
    """(chunk_id, table_name, column_name, column_type, range_start, range_end) by time and space."""
    rows = table(spark, sf_dir, "events").filter("ts is not null").select(chunk_start(F.col("ts")).alias("t"), space_slice(F.col("user_id"), 4).alias("s")).distinct().filter(keep)
    name = F.concat_ws("_", F.lit("e"), "t", "s").alias("chunk_id")
    time = rows.select(name, F.lit("events").alias("table_name"), F.lit("ts").alias("column_name"), F.lit("timestamp").alias("column_type"), F.col("t").alias("range_start"), (F.col("t") + CHUNK).alias("range_end"))
    space = rows.select(name, F.lit("events").alias("table_name"), F.lit("user_id").alias("column_name"), F.lit("bigint").alias("column_type"), F.col("s").alias("range_start"), (F.col("s") + 1).alias("range_end"))
    return time.unionByName(space)


_SPACE = f"SELECT DISTINCT floor(epoch_us(ts) / {CHUNK}.0)::BIGINT * {CHUNK} AS t, user_id % 4 AS s FROM events WHERE ts IS NOT NULL"


@query(f"SELECT 'e_' || t || '_' || s AS source_chunk, 'e_' || t || '_' || s AS target_chunk FROM ({_SPACE}) WHERE s <> 2")
def match_target_chunk(spark, sf_dir):
    return catalog.match_chunks(_slices(spark, sf_dir, F.lit(True)), _slices(spark, sf_dir, F.col("s") != 2))


@query(f"SELECT 'e_' || t || '_' || s AS chunk_id FROM ({_SPACE}) WHERE s = 2")
def target_missing_chunks(spark, sf_dir):
    source = _slices(spark, sf_dir, F.lit(True))
    return catalog.missing_chunks(source, catalog.match_chunks(source, _slices(spark, sf_dir, F.col("s") != 2)))


@query(f"""SELECT 'e_' || t || '_' || s AS chunk_id, '[{{"column_name":"ts","column_type":"timestamp","range_start":' || t || ',"range_end":' || (t + {CHUNK}) ||
    '}},{{"column_name":"user_id","column_type":"bigint","range_start":' || s || ',"range_end":' || (s + 1) || '}}]' AS dimensions FROM ({_SPACE})""")
def chunk_dimensions_json(spark, sf_dir):
    rows = _slices(spark, sf_dir, F.lit(True)).withColumn("slice_id", F.concat_ws("_", "column_name", "range_start"))
    dims = dimensions(spark).filter("hypertable_id = 1")
    slices = rows.join(dims.select("column_name", F.col("id").alias("dimension_id")), "column_name").select(F.col("slice_id").alias("id"), "dimension_id", "range_start", "range_end").distinct()
    return catalog.chunk_dimensions(rows.select("chunk_id", "slice_id"), slices, dims)


@query(f"WITH {CTE}, p AS ({OPEN_PLAN}), t AS ({TIME_PLAN}) SELECT hypertable, chunk_id FROM p WHERE chunk_id NOT IN (SELECT chunk_id FROM t)")
def enqueue_dedup(spark, sf_dir):
    """Some chunks are already staged, with filters that stay as they are."""
    return taskqueue.enqueue(_plan(spark, sf_dir, UNTIL), _plan(spark, sf_dir, UNTIL, FROM)).select("hypertable", "chunk_id")


@query(f"WITH {CTE}, p AS ({OPEN_PLAN}) SELECT hypertable, chunk_id, row_number() OVER (ORDER BY range_start DESC, hypertable, chunk_id)::INTEGER AS priority FROM p")
def queue_priority(spark, sf_dir):
    return taskqueue.with_priority(_plan(spark, sf_dir, UNTIL)).select("hypertable", "chunk_id", "priority")


_QUEUE = f"""p AS ({OPEN_PLAN}), q AS (SELECT *, row_number() OVER (ORDER BY range_start DESC, hypertable, chunk_id)::INTEGER AS priority FROM p),
    t AS (SELECT *, CASE WHEN priority <= 3 THEN priority END AS worked, CASE WHEN priority <= 1 THEN priority END AS verified FROM q)"""


def _tasks(spark, sf_dir):
    tasks = taskqueue.with_priority(_plan(spark, sf_dir, UNTIL))
    return tasks.withColumns({"worked": F.when(F.col("priority") <= 3, F.col("priority")), "verified": F.when(F.col("priority") <= 1, F.col("priority"))})


@query(f"WITH {CTE}, {_QUEUE} SELECT 'copy' AS queue, chunk_id FROM (SELECT * FROM t WHERE worked IS NULL ORDER BY priority LIMIT 1) UNION ALL SELECT 'verify', chunk_id FROM (SELECT * FROM t WHERE worked IS NOT NULL AND verified IS NULL ORDER BY priority LIMIT 1)")
def queue_claim_next(spark, sf_dir):
    tasks = _tasks(spark, sf_dir)
    return taskqueue.next_task(tasks).select(F.lit("copy").alias("queue"), "chunk_id").unionByName(taskqueue.next_task(tasks, True).select(F.lit("verify").alias("queue"), "chunk_id"))


@query(f"WITH {CTE}, {_QUEUE} SELECT 'copy' AS queue, count(*) AS n FROM t WHERE worked IS NULL UNION ALL SELECT 'verify', count(*) FROM t WHERE worked IS NOT NULL AND verified IS NULL")
def queue_pending(spark, sf_dir):
    tasks = _tasks(spark, sf_dir)
    count = lambda name, frame: frame.agg(F.lit(name).alias("queue"), F.count("*").alias("n")).select("queue", "n")
    return count("copy", taskqueue.pending(tasks)).unionByName(count("verify", taskqueue.pending(tasks, True)))


@query(f"""WITH {CTE}, asked AS (SELECT hypertable_id, range_start FROM chunks UNION ALL SELECT hypertable_id, range_start + 7 FROM chunks)
    SELECT a.hypertable_id, a.range_start, EXISTS (SELECT 1 FROM chunks c WHERE NOT c.dropped AND c.hypertable_id = a.hypertable_id AND c.range_start = a.range_start) AS there FROM asked a""")
def chunk_exists(spark, sf_dir):
    """Probes of the catalogue: for chunks that are there, that were dropped, and that never were."""
    known = chunks(spark, sf_dir)
    asked = known.select("hypertable_id", "range_start").unionByName(known.select("hypertable_id", (F.col("range_start") + 7).alias("range_start")))
    return catalog.with_existence(asked, known)


@query(f"WITH {CTE} SELECT chunk_id, ((range_start // {YEAR})::INTEGER & 8) <> 0 AS is_partial FROM chunks WHERE hypertable_id = 2")
def chunk_is_partial(spark, sf_dir):
    own = chunks(spark, sf_dir).filter("hypertable_id = 2")
    return own.select("chunk_id", ((F.col("range_start") / YEAR).cast("int").bitwiseAND(8) != 0).alias("is_partial"))


@query("SELECT o_orderkey FROM orders WHERE list_contains(['1-URGENT', '3-MEDIUM'], o_orderpriority)")
def member_any(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(F.array_contains(F.array(F.lit("1-URGENT"), F.lit("3-MEDIUM")), F.col("o_orderpriority"))).select("o_orderkey")


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT n_name FROM nation")
def set_union_distinct(spark, sf_dir):
    nations, regions = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")), table(spark, sf_dir, "region").select("r_name")
    return nations.union(regions).union(nations).distinct()


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation")
def set_union_all(spark, sf_dir):
    nations, regions = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")), table(spark, sf_dir, "region").select("r_name")
    return nations.unionAll(regions).unionAll(nations)
