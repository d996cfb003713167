"""Registered queries: keys, constraints, ids, audit, paging, geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstar import seeds
from voxstar.functions import location
from voxstar.operators import keys, paging, quality
from voxstar.operators.joins import skew_join
from voxstar.plans import geo, views
from voxstar.suite import standins as s

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
_LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
  ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem"""


def _lines(spark, sf):
    return s.table(spark, sf, "lineitem")


def _line_columns(df):
    return df.select(*[c.strip() for c in _LINE_COLS.split(",")])


def _pk_rejects(spark, sf):
    return _line_columns(keys.tag_first(_lines(spark, sf), LINE_KEY, LINE_ORDER).filter("NOT is_first"))


def _last_wins(spark, sf):
    docs = s.table(spark, sf, "documents").select("lang", "n_chars", "doc_id", F.md5("text").alias("digest"))
    return keys.dedupe_last(docs, ["lang", "n_chars"], ["doc_id"])


def _fk(part):
    def run(spark, sf):
        orders = s.table(spark, sf, "orders")
        parents = s.table(spark, sf, "customer").filter("c_nationkey < 10")
        split = keys.enforce_fk(orders, parents, "o_custkey", "c_custkey")
        return split[part].select("o_orderkey", "o_custkey")
    return run


def _skewed(how):
    def run(spark, sf):
        lines = _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
        marks = s.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
        return skew_join(lines, marks, ["l_orderkey"], how, ["l_linenumber", "l_quantity"], hot_rows=2)
    return run


def _cascade(spark, sf):
    gone = s.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return _line_columns(keys.cascade_delete(_lines(spark, sf), gone, "l_orderkey"))


def _ids(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return keys.assign_ids(orders, "data_id", seeds.DATA_SEED, ["o_orderdate", "o_orderkey"]).select("data_id", "o_orderkey")


_ROLES = [(2000, "assistant"), (2001, "src3"), (2002, "user")]


def _upsert(part):
    def run(spark, sf):
        stored = seeds.literal_frame(spark, "search_id bigint, keyword string", _ROLES)
        incoming = s.table(spark, sf, "documents").select(F.col("source").alias("keyword"))
        return keys.upsert_dim(stored, incoming, ["keyword"], "search_id", seeds.SEARCH_SEED)[part]
    return run


def _resolve(spark, sf):
    dim = _upsert(0)(spark, sf)
    docs = s.table(spark, sf, "documents").select("doc_id", F.col("source").alias("keyword"))
    return keys.resolve_id(docs, dim, ["keyword"], "search_id").select("doc_id", "search_id")


_UPSERT_SQL = f"""old(search_id, keyword) AS (VALUES {', '.join(map(str, _ROLES))}),
fresh AS (SELECT 2002 + row_number() OVER (ORDER BY source) AS search_id, source AS keyword
  FROM (SELECT DISTINCT source FROM documents) WHERE source NOT IN (SELECT keyword FROM old)),
dim AS (SELECT * FROM old UNION ALL SELECT * FROM fresh)"""


def _tagged_orders(spark, sf):
    rules = {"too dear": F.col("o_totalprice") > 250000, "urgent": F.col("o_orderpriority") == "1-URGENT"}
    return quality.tag_rejects(s.table(spark, sf, "orders"), rules)


_BAD = "o_totalprice > 250000 OR o_orderpriority = '1-URGENT'"


def _audit(spark, sf):
    return quality.audit(_tagged_orders(spark, sf), "INITIAL", "ORDERS", "o_orderstatus").drop("run_date")


def _reconcile(spark, sf):
    accepted = _tagged_orders(spark, sf).filter("reject_reason IS NULL")
    customers = quality.tag_rejects(s.table(spark, sf, "customer"), {"negative": F.col("c_acctbal") < 0})
    log = _audit(spark, sf).unionByName(quality.audit(customers, "INITIAL", "CUSTOMERS", "c_mktsegment").drop("run_date"))
    return quality.reconcile(log, {"ORDERS": accepted, "CUSTOMERS": s.table(spark, sf, "customer")})


def _gate(spark, sf):
    docs = (s.table(spark, sf, "documents").join(s.table(spark, sf, "labels"), "doc_id", "left")
            .withColumn("quoted", F.concat(F.lit('"'), "lang", F.lit('" '), "text"))
            .withColumn("number", F.regexp_replace("source", "src1", "x")))
    rules = {"missing key": F.col("quality").isNull(), "bad type": quality.bad_type("number", "int") & (F.col("toxic") == 1),
             "both quote kinds": quality.unquotable("quoted")}
    ok, bad = quality.split_valid(docs.withColumn("number", F.regexp_replace("number", "src", "")), rules)
    return (ok.withColumn("reject_reason", F.lit("none")).select("doc_id", "reject_reason")
            .unionByName(bad.select("doc_id", "reject_reason")))


def page_rows(events):
    return events.select("event_type", F.to_date("ts").alias("day"), "event_id", F.floor("value").alias("result_count"))


def _pages(spark, sf):
    return page_rows(s.table(spark, sf, "events"))


def _cap(spark, sf):
    return paging.cap_pages(_pages(spark, sf), ["event_type", "day"], "event_id", 100, stride=64).select(
        "event_type", "day", "event_id", "result_count", "fetched_before")


_PAGES_SQL = "pages_in AS (SELECT event_type, CAST(ts AS DATE) AS day, event_id, CAST(floor(value) AS BIGINT) AS result_count FROM events)"


def _world(spark, sf):
    c = s.table(spark, sf, "customer")
    null = F.lit(None).cast("string")
    return c.select(F.col("c_name").alias("city"), F.col("c_name").alias("city_ascii"), F.col("c_acctbal").alias("lat"),
                    F.lit(0.0).alias("lng"), null.alias("country"), null.alias("iso2"), null.alias("iso3"),
                    F.concat(F.lit("Nation_"), (F.col("c_nationkey") + 3).cast("string")).alias("admin_name"),
                    null.alias("capital"), F.lit(0.0).alias("population"), F.col("c_custkey").cast("int").alias("id"))


def _cities(spark, sf):
    states = s.table(spark, sf, "nation").select(F.col("n_name").alias("state"), (F.col("n_nationkey") + 1).alias("state_id"))
    return geo.build_cities(_world(spark, sf), states)


def _city_columns(df):
    return df.select("city", "state_province", "city_id", "state_id")


_CITIES_SQL = """cities AS (SELECT c_name AS city, CASE WHEN c_custkey IS NOT NULL THEN p END AS state_province,
    CAST(c_custkey AS INTEGER) AS city_id, coalesce(n_nationkey + 1, 0) AS state_id
  FROM (SELECT *, 'NATION_' || (c_nationkey + 3) AS p FROM customer) FULL JOIN nation ON n_name = p)"""

_FIXES = [3, 17, 44, 101]


def _places(spark, sf):
    u = s.users(spark, sf)
    return u.select("author_id", location.normalise_location(F.col("location")).alias("place"))


def _hierarchy(spark, sf):
    dims = seeds.seed_tables(spark)
    tree = geo.geo_hierarchy(dims["us_states"], dims["divisions"], dims["regions"]).select("state_id", "division", "region")
    placed = geo.author_location(s.users(spark, sf), dims["us_states"], order=["location"])
    return (placed.join(F.broadcast(tree), "state_id").groupBy("region", "division")
            .agg(F.count(F.lit(1)).alias("authors")))


def _paths(spark, sf):
    """Regions, nations and suppliers as one tree of ids and parents; nation 7's parent is one of its own suppliers, a cycle."""
    node = lambda kind, key, parent, name: (F.concat(F.lit(kind), key).alias("id"), parent.alias("parent_id"), F.col(name).alias("name"))
    under = lambda kind, key: F.concat(F.lit(kind), key)
    regions = s.table(spark, sf, "region").select(*node("r", "r_regionkey", F.lit(None).cast("string"), "r_name"))
    up = F.when(F.col("n_nationkey") == 7, F.lit("s1")).otherwise(under("r", "n_regionkey"))
    nations = s.table(spark, sf, "nation").select(*node("n", "n_nationkey", up, "n_name"))
    home = F.when(F.col("s_suppkey") == 1, F.lit("n7")).otherwise(under("n", "s_nationkey"))
    suppliers = s.table(spark, sf, "supplier").select(*node("s", "s_suppkey", home, "s_name"))
    return geo.hierarchy_paths(regions.unionByName(nations).unionByName(suppliers))


_PATHS_SQL = """WITH nodes AS (
  SELECT 'r' || r_regionkey AS id, NULL AS parent_id, r_name AS name FROM region
  UNION ALL SELECT 'n' || n_nationkey, CASE WHEN n_nationkey = 7 THEN 's1' ELSE 'r' || n_regionkey END, n_name FROM nation
  UNION ALL SELECT 's' || s_suppkey, CASE WHEN s_suppkey = 1 THEN 'n7' ELSE 'n' || s_nationkey END, s_name FROM supplier)
SELECT a.id, a.name, CASE WHEN b.id IS NULL THEN 0 WHEN c.id IS NULL AND b.parent_id IS NULL THEN 1 WHEN c.parent_id IS NULL THEN 2 END AS depth,
  CASE WHEN b.id IS NULL THEN a.id WHEN b.parent_id IS NULL THEN b.id WHEN c.parent_id IS NULL THEN c.id END AS root,
  CASE WHEN b.id IS NULL THEN a.name WHEN b.parent_id IS NULL THEN b.name || ' / ' || a.name
       WHEN c.parent_id IS NULL THEN c.name || ' / ' || b.name || ' / ' || a.name END AS path
FROM nodes a LEFT JOIN nodes b ON b.id = a.parent_id LEFT JOIN nodes c ON c.id = b.parent_id"""

_TREE_SQL = "tree(state_id, code, division, region) AS (VALUES " + ", ".join(
    repr((i, code, division, dict(seeds.DIVISIONS)[division])) for i, (code, _, division) in enumerate(seeds.US_STATES, 1)) + ")"


def _per_capita(spark, sf):
    states = seeds.literal_frame(spark, "state_id int, state string", [(i, a) for i, (a, *_) in enumerate(seeds.US_STATES, 1)])
    spent = (s.table(spark, sf, "orders").join(s.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy((F.col("c_nationkey") + 1).alias("state_id")).agg(F.sum(F.floor("o_totalprice")).alias("pop")))
    pops = spent.join(F.broadcast(states), "state_id").select("state", "pop")
    rates = geo.per_capita(pops, geo.users_per_state(s.users(spark, sf)), keep_district=False)
    return rates.withColumns({"per_mil": F.round("per_mil", 6), "ratio": F.round("ratio", 6)})


QUERIES = {
    "pk_dedupe": (lambda spark, sf: _line_columns(keys.dedupe_first(_lines(spark, sf), LINE_KEY, LINE_ORDER)),
                  f"SELECT {_LINE_COLS} FROM ({_RANKED}) WHERE rn = 1"),
    "pk_rejects": (_pk_rejects, f"SELECT {_LINE_COLS} FROM ({_RANKED}) WHERE rn > 1"),
    "last_wins_text": (
        _last_wins,
        """SELECT lang, n_chars, doc_id, md5(text) AS digest FROM (SELECT *, row_number() OVER (
        PARTITION BY lang, n_chars ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1"""),
    "fk_accept": (_fk(0), """SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS
        (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 10)"""),
    "fk_reject": (_fk(1), """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS
        (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 10)"""),
    "skew_join_inner": (_skewed("inner"), """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, o_orderpriority
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P'"""),
    "skew_join_left": (_skewed("left"), """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, o_orderpriority
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_orderkey = l_orderkey"""),
    "skew_join_semi": (_skewed("left_semi"), """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""),
    "cascade_delete": (_cascade, f"""SELECT {_LINE_COLS} FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""),
    "assign_ids": (_ids, """SELECT 4999 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS data_id, o_orderkey FROM orders"""),
    "upsert_dim": (_upsert(0), f"WITH {_UPSERT_SQL} SELECT search_id, keyword FROM dim"),
    "upsert_dim_created": (_upsert(1), f"WITH {_UPSERT_SQL} SELECT search_id, keyword FROM fresh"),
    "resolve_id": (_resolve, f"WITH {_UPSERT_SQL} SELECT doc_id, search_id FROM documents JOIN dim ON keyword = source"),
    "audit_counts": (_audit, f"""SELECT 'INITIAL' AS load_type, o_orderstatus AS filepath,
        'ORDERS: ' || count(*) FILTER (NOT ({_BAD})) || ' LOADED, ' || count(*) FILTER ({_BAD}) || ' SKIPPED' AS comment
        FROM orders GROUP BY o_orderstatus"""),
    "reconcile": (_reconcile, f"""WITH l AS (
          SELECT 'ORDERS' AS table_name, count(*) FILTER (NOT ({_BAD})) AS loaded, count(*) FILTER ({_BAD}) AS skipped,
                 count(*) FILTER (NOT ({_BAD})) AS table_rows FROM orders
          UNION ALL SELECT 'CUSTOMERS', count(*) FILTER (c_acctbal >= 0), count(*) FILTER (c_acctbal < 0), count(*) FROM customer)
        SELECT *, table_rows - loaded AS difference FROM l"""),
    "quality_gate": (_gate, """SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'missing key'
          WHEN toxic = 1 AND TRY_CAST(replace(regexp_replace(source, 'src1', 'x'), 'src', '') AS INTEGER) IS NULL THEN 'bad type'
          WHEN contains(text, '''') THEN 'both quote kinds' ELSE 'none' END AS reject_reason
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""),
    "page_cap": (_cap, f"""WITH {_PAGES_SQL}, r AS (SELECT *, coalesce(sum(result_count) OVER (PARTITION BY event_type, day
          ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS fetched_before FROM pages_in)
        SELECT * FROM r WHERE fetched_before < 100 AND result_count > 0"""),
    "page_totals": (lambda spark, sf: paging.page_totals(_pages(spark, sf), ["event_type", "day"]),
                    f"""WITH {_PAGES_SQL} SELECT event_type, day, sum(result_count)::BIGINT AS total, count(*) AS pages
        FROM pages_in GROUP BY ALL"""),
    "build_cities": (lambda spark, sf: _city_columns(_cities(spark, sf)),
                     f"WITH {_CITIES_SQL} SELECT city, state_province, city_id, state_id FROM cities"),
    "vw_us_cities": (lambda spark, sf: _city_columns(views.vw_us_cities(_cities(spark, sf))),
                     f"WITH {_CITIES_SQL} SELECT city, state_province, city_id, state_id FROM cities WHERE state_id <> 0"),
    "city_correction": (lambda spark, sf: _city_columns(keys.correct(_cities(spark, sf), "city_id", _FIXES, "state_id", 0)),
                        f"""WITH {_CITIES_SQL} SELECT city, state_province, city_id,
        CASE WHEN city_id IN {tuple(_FIXES)} THEN 0 ELSE state_id END AS state_id FROM cities"""),
    "location_to_state": (_places, f"""WITH {s.USERS_SQL} SELECT author_id, coalesce(c.code, place) AS place
        FROM stripped LEFT JOIN codes c ON c.title = place"""),
    "author_location": (lambda spark, sf: geo.author_location(s.users(spark, sf), s.us_states(spark)),
                        f"WITH {s.USERS_SQL} SELECT author_id, state_id FROM located JOIN states ON code = state_abbr"),
    "users_per_state": (lambda spark, sf: geo.users_per_state(s.users(spark, sf)),
                        f"WITH {s.USERS_SQL} SELECT state_abbr, count(*) AS users FROM located GROUP BY state_abbr"),
    "geo_hierarchy": (_hierarchy, f"""WITH {s.USERS_SQL}, {_TREE_SQL} SELECT region, division, count(*) AS authors
        FROM located JOIN tree t ON t.code = state_abbr GROUP BY region, division"""),
    "geo_paths": (_paths, _PATHS_SQL),
    "per_capita": (_per_capita, f"""WITH {s.USERS_SQL}, pops AS (SELECT code AS state, sum(floor(o_totalprice))::BIGINT AS pop
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN states ON state_id = c_nationkey + 1 GROUP BY code),
        per AS (SELECT state_abbr, count(*) AS users FROM located GROUP BY state_abbr)
        SELECT state, pop, users, round(users::DOUBLE / pop * 1e6, 6) AS per_mil, round(users::DOUBLE / pop * 1e5, 6) AS ratio
        FROM pops JOIN per ON state_abbr = state WHERE state <> 'DC'"""),
}
