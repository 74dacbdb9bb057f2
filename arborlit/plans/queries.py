"""Registered queries of the engine's own operators, on the driver's tables.

The tables stand in for annotated literature: line items are mentions, suppliers
terms below nation and region, parts genes, orders and customers documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators import classify, documents, explore, intervals, latest, mentions, metrics, ontology, rollup, trees, vocabulary
from arborlit.sources import schemas as S
from arborlit.sources.durable import durable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term_id, name, path_parts, tree_id, web_id): suppliers below nation and region."""
    supplier, nation, region = load(spark, sf_dir, "supplier", "nation", "region")
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    return rows.select(F.col("s_suppkey").alias("term_id"), F.col("s_name").alias("name"), F.array("r_name", "n_name", "s_name").alias("path_parts"), F.col("n_nationkey").cast("string").alias("tree_id"), F.col("s_suppkey").cast("string").alias("web_id"), F.lit(0).alias("branch_index"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lineitem,) = load(spark, sf_dir, "lineitem")
    return lineitem.select(F.col("l_orderkey").alias("pmid"), F.col("l_suppkey").alias("term_id"), F.col("l_partkey").alias("gene_id"), F.col("l_linenumber").alias("ord"))


def placed_facts(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    return (items(spark, sf_dir) if rows is None else rows).join(latest.dimension(places(spark, sf_dir)), "term_id", "left")


PLACES = """place AS (
    SELECT s_suppkey, s_name, n_name, r_name, r_name || '.' || n_name || '.' || s_name AS path, n_nationkey::VARCHAR AS tree_id, s_suppkey::VARCHAR AS web_id
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query(f"WITH {PLACES} SELECT s_suppkey AS term_id, path, count(*) AS n, max(web_id) AS web_id, max(tree_id) AS tree_id FROM lineitem JOIN place ON l_suppkey = s_suppkey GROUP BY ALL ORDER BY n DESC, term_id, path")
def tree_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions by term and path, largest first."""
    return trees.ordered_tree(trees.term_tree(items(spark, sf_dir), places(spark, sf_dir)), "term_id").select("term_id", "path", "n", "web_id", "tree_id")


@query("""SELECT l_orderkey AS pmid, l_partkey AS term_id, b.i AS branch_index, CASE b.i WHEN 0 THEN p_type || '.' || p_brand ELSE p_brand || '.' || p_name END AS path, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey CROSS JOIN (VALUES (0), (1)) b(i) GROUP BY ALL""")
def multi_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each mention at every place of its term."""
    (part,) = load(spark, sf_dir, "part")
    branches = part.select(F.col("p_partkey").alias("gene_id"), F.posexplode(F.array(F.array("p_type", "p_brand"), F.array("p_brand", "p_name"))).alias("branch_index", "path_parts"))
    return items(spark, sf_dir).join(branches, "gene_id").groupBy("pmid", F.col("gene_id").alias("term_id"), "branch_index", X.path_text("path_parts").alias("path")).agg(F.count("*").alias("n"))


def part_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = load(spark, sf_dir, "part")
    return trees.gene_classes("groups", part.select(F.col("p_partkey").alias("gene_id"), F.array("p_type", "p_brand").alias("path_parts")))


@query("""SELECT gene_id, path, count(*) AS n, gene_id AS web_id, path AS tree_id
FROM (SELECT DISTINCT l_orderkey, l_partkey AS gene_id, p_type || '.' || p_brand AS path FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY gene_id, path""")
def gene_doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by gene and class path."""
    return trees.gene_tree(items(spark, sf_dir), part_classes(spark, sf_dir))[0]


@query("""WITH s AS (SELECT DISTINCT l_orderkey, l_partkey, p_type || '.' || p_brand AS path, p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT l_orderkey, name, min((l_partkey, path)) AS o FROM s GROUP BY ALL)
SELECT l_orderkey AS pmid, string_agg(name, ' | ' ORDER BY o, name) || ' | ' AS subjects FROM f GROUP BY l_orderkey""")
def gene_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class names that a document's genes belong to, by gene and class."""
    names = trees.gene_tree(items(spark, sf_dir), part_classes(spark, sf_dir))[1]
    return names.select("pmid", X.subjects_text("names").alias("subjects"))


@query(f"""WITH {PLACES}, f AS (SELECT l_orderkey, n_name, min(l_linenumber) AS o FROM lineitem JOIN place ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT l_orderkey AS pmid, string_agg(n_name, ' | ' ORDER BY o, n_name) || ' | ' AS subjects FROM f GROUP BY l_orderkey""")
def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's distinct names in the order in which they first occur."""
    rows = placed_facts(spark, sf_dir).withColumn("name", F.get("path_parts", F.lit(1)))
    return mentions.subjects(rows).select("pmid", X.subjects_text("names").alias("subjects"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user."""
    (events,) = load(spark, sf_dir, "events")
    return latest.last_wins(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type."""
    (events,) = load(spark, sf_dir, "events")
    return latest.first_seen(events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""WITH x AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 7 = 0 THEN '{bad' ELSE props END AS p FROM events)
SELECT user_id, event_id, (p::JSON ->> 'k')::BIGINT AS k FROM x WHERE json_valid(p) AND (p::JSON ->> 'k') IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def cache_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last readable JSON line of each key."""
    (events,) = load(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("{bad")).otherwise(F.col("props"))
    rows = events.select("user_id", "event_id", "ts", F.from_json(raw, "k LONG").alias("r")).where("r.k is not null").select("user_id", "event_id", "ts", F.col("r.k").alias("k"))
    return latest.last_wins(rows, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "k")


@query("""WITH c AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'system') AS typed, arg_min(text, turn) AS first, list(text ORDER BY turn)[2] AS second, arg_min(text, turn) FILTER (WHERE role = 'user') AS asked FROM conversations GROUP BY conv_id)
SELECT conv_id, coalesce(nullif(typed, ''), nullif(first, ''), '') AS title, coalesce(nullif(asked, ''), nullif(second, ''), '') AS abstract FROM c""")
def passage_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first passage of a type, else the first or second passage."""
    (turns,) = load(spark, sf_dir, "conversations")
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    passages = F.transform("t", lambda x: F.struct(x["text"].alias("text"), F.create_map(F.lit("type"), x["role"]).alias("infons")))
    rows = rows.select("conv_id", passages.alias("ps"))
    return rows.select("conv_id", X.first_filled(documents.passage_by_type(F.col("ps"), "SYSTEM"), F.get("ps", F.lit(0))["text"]).alias("title"), X.first_filled(documents.passage_by_type(F.col("ps"), "user"), F.get("ps", F.lit(1))["text"]).alias("abstract"))


def citation_text() -> Column:
    """A journal citation in one of eight shapes, by order key."""
    day = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 8
    shapes = [
        F.concat(F.lit("J Med. Abbr; "), day("yyyy MMM d"), F.lit(";12:3. doi: 10.1/"), F.col("o_orderkey").cast("string")),
        F.concat(F.lit("J Med; "), day("yyyy MMM"), F.lit(" doi:10.2/"), F.col("o_orderkey").cast("string")),
        F.concat(F.lit("J Med, published "), day("yyyy")),
        F.concat(F.lit("J Med; "), day("yyyy-MM-dd"), F.lit(" PMID: 77")),
        F.concat(F.lit("J Med; "), day("yyyyMM"), F.lit(". rest")),
        F.concat(F.lit("J Med; "), day("yyyy"), F.lit(";8")),
        F.concat(F.lit("J Med; "), day("yyyy MMM"), F.lit("uary 5;1")),
        F.lit(""),
    ]
    out = shapes[-1]
    for n, s in enumerate(shapes[:-1]):
        out = F.when(k == n, s).otherwise(out)
    return out


JOURNAL = """j AS (SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN 'J Med. Abbr; ' || strftime(o_orderdate, '%Y %b ') || day(o_orderdate) || ';12:3. doi: 10.1/' || o_orderkey
    WHEN 1 THEN 'J Med; ' || strftime(o_orderdate, '%Y %b') || ' doi:10.2/' || o_orderkey
    WHEN 2 THEN 'J Med, published ' || strftime(o_orderdate, '%Y')
    WHEN 3 THEN 'J Med; ' || strftime(o_orderdate, '%Y-%m-%d') || ' PMID: 77'
    WHEN 4 THEN 'J Med; ' || strftime(o_orderdate, '%Y%m') || '. rest'
    WHEN 5 THEN 'J Med; ' || strftime(o_orderdate, '%Y') || ';8'
    WHEN 6 THEN 'J Med; ' || strftime(o_orderdate, '%Y %b') || 'uary 5;1' ELSE '' END AS journal FROM orders),
cut AS (SELECT *, len(string_split(journal, ';')) AS pieces, trim(string_split(trim(string_split(trim(string_split(trim(coalesce(string_split(journal, ';')[2], '')), '. ')[1]), ' doi:')[1]), ' PMID:')[1]) AS raw FROM j),
named AS (SELECT *, regexp_extract(raw, '\\b((?:19|20)\\d{2})\\s*(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\\s*(\\d{1,2})?\\b', ['y', 'm', 'd']) AS g,
    regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(raw, 'Jan', '01'), 'Feb', '02'), 'Mar', '03'), 'Apr', '04'), 'May', '05'), 'Jun', '06'), 'Jul', '07'), 'Aug', '08'), 'Sep', '09'), 'Oct', '10'), 'Nov', '11'), 'Dec', '12'), '[^0-9]', '', 'g') AS digits,
    regexp_extract(journal, '\\b((?:19|20)\\d{2})\\b', 1) AS only_year FROM cut),
parts AS (SELECT *, lpad(list_position(['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'], g.m)::VARCHAR, 2, '0') AS mm,
    CASE WHEN g.d = '' THEN '01' ELSE lpad(g.d, 2, '0') END AS dd, length(digits) IN (4, 6) OR length(digits) >= 8 AS fits FROM named)"""


@query(f"""WITH {JOURNAL}
SELECT o_orderkey AS pmid,
    CASE WHEN pieces < 2 THEN only_year WHEN g.y <> '' THEN g.y || mm || dd WHEN fits THEN substr(digits, 1, 8) ELSE '' END AS date,
    CASE WHEN pieces < 2 THEN only_year WHEN g.y <> '' THEN g.y WHEN fits THEN substr(digits, 1, 4) ELSE '' END AS year,
    CASE WHEN pieces < 2 THEN '' WHEN g.y <> '' THEN mm WHEN fits THEN CASE WHEN length(digits) >= 6 THEN substr(digits, 5, 2) ELSE '01' END ELSE '' END AS month,
    CASE WHEN pieces < 2 THEN '' WHEN g.y <> '' THEN dd WHEN fits THEN CASE WHEN length(digits) >= 8 THEN substr(digits, 7, 2) ELSE '01' END ELSE '' END AS day,
    regexp_extract(journal, '(?i)doi:\\s*([^;\\s]+)', 1) AS doi FROM parts""")
def journal_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and DOIs read from journal citations."""
    (orders,) = load(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderkey").alias("pmid"), citation_text().alias("journal")).withColumn("d", X.journal_date("journal"))
    none = F.lit("")
    return rows.select("pmid", *(F.col(f"d.{k}").alias(k) for k in ("date", "year", "month", "day")), X.doi(none, none, F.col("journal")).alias("doi"))


@query("""WITH s AS (SELECT c_custkey::VARCHAR AS pmid, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS title, c_mktsegment AS journal FROM customer),
r AS (SELECT o_custkey::VARCHAR AS pmid, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT s.pmid, coalesce(r.o_orderkey::VARCHAR, '') AS id, CASE WHEN r.pmid IS NULL THEN title ELSE 'T' || r.o_orderkey END AS title_e, CASE WHEN r.pmid IS NULL THEN '' ELSE 'A' || r.o_orderkey END AS abstract,
    coalesce(strftime(o_orderdate, '%Y%m%d'), '') AS date, coalesce(strftime(o_orderdate, '%Y'), '') AS year, CASE WHEN r.pmid IS NULL THEN 'search' ELSE 'cache' END AS source,
    CASE WHEN r.pmid IS NULL THEN 'failed' ELSE 'ok' END AS fetch_status, CASE WHEN r.pmid IS NULL THEN 'absent_from_response' ELSE '' END AS failure_reason, CASE WHEN r.pmid IS NULL THEN '1' ELSE '0' END AS failed
FROM s LEFT JOIN r USING (pmid)""")
def doc_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table: customers are searched for, their last open order is the record."""
    return built(spark, sf_dir).select("pmid", "id", "title_e", "abstract", "date", "year", "source", "fetch_status", "failure_reason", "failed")


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = load(spark, sf_dir, "customer", "orders")
    search = customer.select(F.col("c_custkey").cast("string").alias("pmid"), F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(F.col("c_name")).alias("title_e"), F.col("c_mktsegment").alias("journal"), F.col("c_custkey").alias("ord"))
    last = latest.last_wins(orders.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderkey"])
    text = lambda p: F.concat(F.lit(p), F.col("o_orderkey").cast("string"))
    passage = lambda t, kind: F.struct(t.alias("text"), F.create_map(F.lit("type"), F.lit(kind)).alias("infons"), F.array().cast(f"array<{S.ANNOTATION}>").alias("annotations"))
    none = F.lit(None).cast("string")
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), none.alias("pmid"), none.alias("pmcid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), none.alias("year"), none.alias("journal"), none.alias("doi"), none.alias("article-id_doi"), none.alias("authors"), F.array(passage(text("T"), "title"), passage(text("A"), "abstract")).alias("passages"))
    return documents.build_documents(search, last.select(F.col("o_custkey").cast("string").alias("pmid"), record.alias("record")))


@query("""WITH r AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus <> 'F')
SELECT count(o_custkey)::BIGINT AS ok, (count(*) - count(o_custkey))::BIGINT AS failed, count(*)::BIGINT AS total FROM customer LEFT JOIN r ON c_custkey = o_custkey""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.run_status(built(spark, sf_dir))


@query("SELECT c_custkey::VARCHAR AS pmid, 'absent_from_response' AS failure_reason FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'F')")
def failed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.failed_ids(built(spark, sf_dir))


def node_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, their documents, the tree) of suppliers, parts being genes."""
    place = latest.dimension(durable(places(spark, sf_dir).select("term_id", X.path_text("path_parts").alias("path"))))
    rows, held = items(spark, sf_dir), durable(intervals.labels(place))
    by_term = lambda c: rows.select("term_id", c).distinct().join(place, "term_id").drop("term_id")
    tree, docs = by_term("gene_id"), by_term("pmid")
    return durable(rollup.hierarchy(tree, docs, held=held)), docs, tree  # a row a node, read several times


NODES = f"""{PLACES}, flat AS (SELECT l_orderkey AS pmid, l_partkey AS gene, r_name, n_name, s_name FROM lineitem JOIN place ON l_suppkey = s_suppkey),
up AS (SELECT pmid, gene, r_name AS path, '' AS parent_path, 1 AS depth, r_name AS name FROM flat UNION ALL SELECT pmid, gene, r_name || '.' || n_name, r_name, 2, n_name FROM flat
    UNION ALL SELECT pmid, gene, r_name || '.' || n_name || '.' || s_name, r_name || '.' || n_name, 3, s_name FROM flat),
nodes AS (SELECT path, parent_path, depth, name, count(DISTINCT pmid)::BIGINT AS documents, count(DISTINCT gene)::BIGINT AS genes FROM up GROUP BY ALL)"""


@query(f"WITH {NODES} SELECT * FROM nodes")
def rollup_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents and genes under every node."""
    return node_table(spark, sf_dir)[0]


@query(f"""WITH {NODES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY parent_path ORDER BY documents DESC, path) AS rank FROM nodes WHERE depth <= 2),
cut AS (SELECT * FROM ranked WHERE rank > 3), rest AS (SELECT parent_path, count(*) AS k, max(documents) AS documents FROM cut GROUP BY ALL),
g AS (SELECT c.parent_path, count(DISTINCT gene)::BIGINT AS genes FROM cut c JOIN up u ON u.path = c.path GROUP BY ALL)
SELECT parent_path, rank::INTEGER AS rank, path, name, documents, genes FROM ranked WHERE rank <= 3 AND (parent_path = '' OR parent_path IN (SELECT path FROM ranked WHERE rank <= 3))
UNION ALL SELECT r.parent_path, 4, NULL, k || ' more', documents, g.genes FROM rest r JOIN g USING (parent_path) WHERE r.parent_path = '' OR r.parent_path IN (SELECT path FROM ranked WHERE rank <= 3)""")
def topk_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three children of each node to depth 2, and the rest as one."""
    nodes, _, tree = node_table(spark, sf_dir)
    return rollup.prune(nodes, tree.withColumnRenamed("gene_id", "gene"), 3, 2)


@query(f"WITH {NODES} SELECT path, name, documents FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM nodes c WHERE c.parent_path = n.path) ORDER BY documents DESC, path LIMIT 12")
def leaf_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.top_leaves(node_table(spark, sf_dir)[0])


@query(f"WITH {NODES} SELECT name, documents FROM nodes WHERE depth = 1 ORDER BY documents DESC, name LIMIT 8")
def composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.composition(node_table(spark, sf_dir)[0], 8)


@query("""SELECT gene_id AS gene, leaf, max(n) AS documents FROM (SELECT l_partkey AS gene_id, p_type || '.' || p_brand AS path, p_brand AS leaf, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
GROUP BY ALL ORDER BY documents DESC, gene, leaf LIMIT 12""")
def top_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.top_associations(trees.gene_tree(items(spark, sf_dir), part_classes(spark, sf_dir))[0])


@query(f"WITH {NODES} SELECT count(DISTINCT pmid)::BIGINT AS documents, count(DISTINCT gene)::BIGINT AS genes, count(DISTINCT s_name)::BIGINT AS categories FROM flat")
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = placed_facts(spark, sf_dir)
    return rollup.summary(facts, facts.select("gene_id", X.path_text("path_parts").alias("path")))


@query(f"""WITH {PLACES}, b AS (SELECT *, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'other' ELSE r_name END AS bucket FROM place)
SELECT bucket, count(DISTINCT l_orderkey)::BIGINT AS docs, (SELECT count(*) FROM b x WHERE x.bucket = b.bucket)::BIGINT AS entries FROM lineitem JOIN b ON l_suppkey = s_suppkey GROUP BY bucket""")
def split_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree entries and documents of each bucket."""
    place = places(spark, sf_dir).withColumn("path", X.path_text("path_parts"))
    bucketed = place.withColumn("bucket", X.bucket("path", lumped=("ASIA", "EUROPE")))
    leaves = bucketed.select(X.leaf("path").alias("leaf"), "bucket").distinct()
    docs = mentions.subjects(placed_facts(spark, sf_dir)).select("pmid", F.explode("names").alias("leaf")).join(leaves, "leaf").groupBy("bucket").agg(F.count_distinct("pmid").alias("docs"))
    return docs.join(bucketed.groupBy("bucket").agg(F.count("*").alias("entries")), "bucket")


@query("""SELECT c_custkey AS pmid, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, ''), CASE WHEN c_custkey % 2 = 0 THEN 'N' || c_nationkey END, '') AS cat,
    c_custkey % 6 = 0 OR (c_mktsegment = '' AND c_custkey % 2 = 0) AS filled FROM customer""")
def fill_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank categories filled from a second table, others kept."""
    (customer,) = load(spark, sf_dir, "customer")
    docs = customer.select(F.col("c_custkey").alias("pmid"), F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("cat"))
    other = customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("pmid"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("cat"))
    return trees.fill_blanks(docs, other, ("cat",)).select("pmid", "cat", F.col("filled_cat").alias("filled"))


@query("""WITH m AS (SELECT c_nationkey, count(*)::BIGINT AS display, avg(c_custkey) AS cited FROM customer GROUP BY ALL)
SELECT o_orderkey AS pmid, o_totalprice AS citation_count, n_name AS openalex_journal_name, m.cited AS openalex_2yr_mean_citedness FROM orders JOIN customer ON o_custkey = c_custkey JOIN m USING (c_nationkey) LEFT JOIN nation ON n_nationkey = c_nationkey""")
def two_hop_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's metrics, and those of its source."""
    orders, customer, nation = load(spark, sf_dir, "orders", "customer", "nation")
    docs = orders.select(F.col("o_orderkey").alias("pmid"), F.lit("ok").alias("fetch_status"))
    none = F.lit(None).cast("double")
    values = orders.select(F.col("o_orderkey").alias("key"), F.struct(F.col("o_totalprice").alias("citation_count"), none.alias("relative_citation_ratio"), none.alias("nih_percentile")).alias("value"))
    works = orders.join(customer, orders.o_custkey == customer.c_custkey).select(F.col("o_orderkey").alias("key"), F.struct(F.col("c_nationkey").alias("source_id")).alias("value"))
    stats = customer.groupBy("c_nationkey").agg(F.avg("c_custkey").alias("two_yr_mean_citedness")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    sources = stats.select(F.col("c_nationkey").alias("key"), F.struct(F.col("n_name").alias("display_name"), "two_yr_mean_citedness").alias("value"))
    return metrics.citation_table(docs, values, works, sources).select("pmid", "citation_count", "openalex_journal_name", "openalex_2yr_mean_citedness")


@query(f"WITH {PLACES} SELECT s_suppkey AS term_id, path, count(*)::BIGINT AS n, max(web_id) AS web_id, max(tree_id) AS tree_id FROM lineitem JOIN place ON l_suppkey = s_suppkey GROUP BY ALL")
def additive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of even documents merged with that of odd ones: the tree of all."""
    rows = items(spark, sf_dir)
    even, odd = (trees.term_tree(rows.where(F.col("pmid") % 2 == k), places(spark, sf_dir)) for k in (0, 1))
    return trees.merge_counts(even, odd, ("term_id", "path"))


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(c_name), 'customer') AND contains(lower(c_mktsegment), 'b')
ORDER BY length(regexp_replace(c_name, '[^0-9].*?', '', 'g')), c_name, c_custkey LIMIT 25 OFFSET 25""")
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a search, in natural order."""
    (customer,) = load(spark, sf_dir, "customer")
    rows = explore.search(explore.search(customer.select("c_custkey", "c_name", "c_mktsegment"), " CUSTOMER ", ["c_name"]), "B", ["c_mktsegment"])
    return explore.page(explore.naturally_sorted(rows, "c_name", ties=["c_custkey"]), 1, pages=1 << 30)


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS t, x.k AS place, (n_nationkey - x.k - 1) // (x.k + 1) AS parent FROM nation CROSS JOIN (VALUES (0), (1)) x(k) WHERE n_nationkey > x.k),
w AS (SELECT n_nationkey AS t, n_nationkey AS at, [n_name] AS chain, []::INTEGER[] AS places FROM nation
    UNION ALL SELECT w.t, e.parent, list_prepend(n_name, chain), list_append(places, e.place) FROM w JOIN e ON e.t = w.at JOIN nation ON n_nationkey = e.parent),
done AS (SELECT w.t, chain, places FROM w WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.t = w.at) QUALIFY row_number() OVER (PARTITION BY w.t ORDER BY places) <= 8)
SELECT t::VARCHAR AS term_id, 'Gene Ontology.' || array_to_string(chain, '.') AS path FROM done GROUP BY ALL""")
def dag_lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight chains of each node of a graph on the nations."""
    (nation,) = load(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    parents = F.filter(F.array(F.when(k > 0, (k - 1).cast("int").cast("string")), F.when(k > 1, F.floor((k - 2) / 2).cast("int").cast("string"))), lambda p: p.isNotNull())
    terms = nation.select(k.cast("string").alias("term_id"), F.col("n_name").alias("name"), F.lit("").alias("namespace"), parents.alias("parents"))
    return ontology.dag_lineages(terms).select("term_id", X.path_text("path_parts").alias("path"))


GRAPH = """e AS (SELECT o_orderkey AS t, p.place, CASE p.place WHEN 0 THEN o_orderkey // 3 WHEN 1 THEN o_orderkey // 2 ELSE o_orderkey * 2 END AS parent
    FROM orders, (VALUES (0), (1), (2)) p(place) WHERE p.place < 2 OR o_orderkey % 1000 = 507),
known AS (SELECT e.* FROM e JOIN orders ON o_orderkey = e.parent)"""


@query(f"""WITH RECURSIVE {GRAPH},
w AS (SELECT o_orderkey AS t, o_orderkey AS cur, [o_orderkey] AS chain, []::BIGINT[] AS visited, []::INTEGER[] AS places, 0 AS depth, false AS ended FROM orders
    UNION ALL
    SELECT t, cur, chain, visited, places, depth, ended FROM (
        SELECT w.t, coalesce(k.parent, w.cur) AS cur, CASE WHEN k.parent IS NULL THEN chain ELSE list_prepend(k.parent, chain) END AS chain,
               CASE WHEN k.parent IS NULL THEN visited ELSE list_append(visited, w.cur) END AS visited,
               CASE WHEN k.parent IS NULL THEN places ELSE list_append(places, k.place) END AS places, depth + 1 AS depth, k.parent IS NULL AS ended
        FROM w LEFT JOIN known k ON k.t = w.cur AND NOT w.ended AND NOT list_contains(w.visited, k.parent) WHERE depth < 25
        QUALIFY row_number() OVER (PARTITION BY w.t ORDER BY CASE WHEN k.parent IS NULL THEN places ELSE list_append(places, k.place) END) <= 8)),
done AS (SELECT DISTINCT t, 'Gene Ontology.' || array_to_string(chain, '.') AS path FROM w WHERE depth = 25)
SELECT t::VARCHAR AS term_id, path FROM done""")
def graph_lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight chains of every order in a graph of orders: each lies below two others, so walks meet again, and some lie on cycles."""
    (orders,) = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    parents = F.array(F.expr("o_orderkey div 3"), F.expr("o_orderkey div 2"), F.when(k % 1000 == 507, k * 2))
    terms = orders.select(k.cast("string").alias("term_id"), k.cast("string").alias("name"), F.lit("").alias("namespace"), F.transform(F.array_compact(parents), lambda p: p.cast("string")).alias("parents"))
    return ontology.dag_lineages(terms).select("term_id", X.path_text("path_parts").alias("path"))


@query("""SELECT page_id, trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) AS title, length(regexp_replace(html, '<[^>]*>', '', 'g'))::INTEGER AS text_chars FROM pages""")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and the length of the text without tags."""
    (pages,) = load(spark, sf_dir, "pages")
    return pages.select("page_id", F.trim(F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1)).alias("title"), F.length(F.regexp_replace("html", "<[^>]*>", "")).alias("text_chars"))


@query("""SELECT p_brand AS leaf, arg_min(p_type || '.' || p_brand, p_partkey) AS path FROM part GROUP BY p_brand""")
def first_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first path of each leaf name."""
    (part,) = load(spark, sf_dir, "part")
    return rollup.leaf_paths(part.select(F.concat_ws(".", "p_type", "p_brand").alias("path"), F.col("p_partkey").alias("ord")), first_only=True)


@query("""SELECT l_orderkey AS pmid, string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) AS gene_ids FROM lineitem GROUP BY ALL""")
def gene_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).withColumn("gene_id", F.col("gene_id").cast("string"))
    return mentions.gene_sets(rows).select("pmid", F.array_join("gene_ids", ",").alias("gene_ids"))


@query("SELECT count(*)::BIGINT AS mentions, count(DISTINCT (l_orderkey, l_partkey))::BIGINT AS pairs, count(DISTINCT l_partkey)::BIGINT AS genes FROM lineitem")
def mention_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.totals(items(spark, sf_dir))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 20 + 1 AS batch FROM orders")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in batches of 20."""
    (orders,) = load(spark, sf_dir, "orders")
    return latest.batch_number(orders.select("o_orderkey", "o_orderdate"), 20, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch")


@query("""WITH j AS (SELECT o_orderpriority AS label, CASE WHEN o_orderkey % 3 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS p FROM orders), l AS (SELECT label FROM j UNION SELECT p FROM j),
c AS (SELECT l.label, (SELECT count(*) FROM j WHERE j.label = l.label) AS support, (SELECT count(*) FROM j WHERE j.p = l.label) AS chosen, (SELECT count(*) FROM j WHERE j.label = l.label AND j.p = l.label) AS r FROM l),
m AS (SELECT *, CASE WHEN chosen = 0 THEN 0 ELSE r::DOUBLE / chosen END AS precision, CASE WHEN support = 0 THEN 0 ELSE r::DOUBLE / support END AS recall FROM c)
SELECT label, precision, recall, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1, support FROM m""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 by class."""
    (orders,) = load(spark, sf_dir, "orders")
    guess = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1-URGENT")).otherwise(F.col("o_orderpriority"))
    return classify.report(orders.select(F.col("o_orderpriority").alias("l"), guess.alias("p")), "l", "p")


@query("""WITH t AS (SELECT r_regionkey::VARCHAR AS n, r_name AS name FROM region UNION ALL SELECT n_regionkey || '.' || n_nationkey, n_name FROM nation UNION ALL SELECT n_regionkey || '.' || n_nationkey || '.' || s_suppkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT t.n AS tree_id, t.name, CASE len(string_split(t.n, '.')) WHEN 1 THEN t.name WHEN 2 THEN r_name || '.' || t.name ELSE r_name || '.' || n_name || '.' || t.name END AS path
FROM t JOIN region ON r_regionkey::VARCHAR = string_split(t.n, '.')[1] LEFT JOIN nation ON n_nationkey::VARCHAR = string_split(t.n, '.')[2]""")
def vocabulary_lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineage of every tree number, from prefixes."""
    supplier, nation, region = load(spark, sf_dir, "supplier", "nation", "region")
    text = lambda *c: F.concat_ws(".", *(F.col(x).cast("string") for x in c))
    below = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    rows = region.select(text("r_regionkey").alias("t"), F.col("r_name").alias("name")).unionByName(nation.select(text("n_regionkey", "n_nationkey").alias("t"), F.col("n_name").alias("name"))).unionByName(below.select(text("n_regionkey", "n_nationkey", "s_suppkey").alias("t"), F.col("s_name").alias("name")))
    found = vocabulary.term_branches(rows.select(F.concat(F.lit("D"), "t").alias("dui"), "name", F.array("t").alias("tree_numbers")))
    return found.select("tree_id", "name", X.path_text("path_parts").alias("path"))


@query()
def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted quality of unlabelled documents (a model, so no SQL)."""
    docs, labels = load(spark, sf_dir, "documents", "labels")
    rows = docs.join(labels, "doc_id", "left").select(F.col("doc_id").cast("string").alias("pmid"), F.col("text").alias("title_e"), F.lit("").alias("abstract"), F.concat(F.col("lang"), F.lit(" | "), F.col("source"), F.lit(" | ")).alias("subjects"), F.coalesce(F.concat(F.lit("q"), F.col("quality").cast("string")), F.lit("")).alias("hard_category"))
    trained = classify.train(rows, "hard_category")
    return classify.predict(trained, rows, "hard_category")
