"""Readers of the workload's files, each to a DataFrame.

Text formats are read by Spark's own readers; only the length of a preamble is
found by looking at a file's first lines.  Where order decides (the later line
wins), rows carry ``ord``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators.carry import carry_down
from arborlit.operators.latest import last_wins, with_order
from arborlit.sources import json_array
from arborlit.sources import schemas as S

PREAMBLE_LINES = 10_000

# Fixed value: the key of a response's wrapper object.
WRAPPER = "PubTator3"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, local or of any file system that Spark knows, is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def search_results(spark: SparkSession, path: str, skip: int = -1) -> DataFrame:
    """Rows of a search export, all strings, blanks for missing values, with ``ord``.

    Commas separate if the name ends in .csv, else tabs; quotes are plain
    characters.  ``skip`` -1: leading lines that are blank or start with ``#`` are
    skipped (later such lines are data).  Each file of a folder has the header of
    the first one.  Without a pmid column: an error.
    """
    sep = "," if path.lower().endswith(".csv") else "\t"
    lines = spark.read.text(path)
    head = [r.value for r in lines.limit(PREAMBLE_LINES).collect()]  # from the first file's beginning
    if skip < 0:
        skip = next((k for k, x in enumerate(head) if x.strip() and not x.startswith("#")), len(head))
    names = head[skip].rstrip("\r").split(sep) if skip < len(head) else []
    if "pmid" not in names:
        raise ValueError(f"{path} has no pmid column")
    # a file's rows follow its header line, the first that reads like this; the lines aren't numbered, so files stay split
    ordered = with_order(lines)
    begins = ordered.where(F.col("value") == head[skip]).groupBy("ord.file").agg(F.min("ord.line").alias("begin"))
    cells = F.split(F.regexp_replace("value", "\r$", ""), sep, -1)
    rows = ordered.join(begins, ordered["ord.file"] == begins["file"]).where((F.col("ord.line") > F.col("begin")) & (F.trim("value") != "")).select(cells.alias("c"), "ord")
    return rows.select(*(F.coalesce(F.get("c", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)), "ord")


def previous_dates(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, dates) from an earlier output; the last row of an id wins; a missing file is empty.

    A date is made of the parts if it's missing; rows without date and year don't count.
    """
    if not path or not exists(spark, path):
        return empty(spark, S.DATES)
    rows = with_order(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    get = lambda c: X.clean_number(c) if c in rows.columns else F.lit("")
    key = X.strip("pmid" if "pmid" in rows.columns else "id")
    padded = lambda c: F.when(get(c) == "", F.lit("")).otherwise(X.zero_pad(get(c)))
    parts = rows.select(key.alias("pmid"), get("date").alias("d"), get("year").alias("y"), padded("month").alias("m"), padded("day").alias("day"), "ord")
    date = F.when((F.col("d") == "") & (F.col("y") != ""), X.join_filled([F.col("y"), F.col("m"), F.col("day")])).otherwise(F.col("d"))
    parts = parts.withColumn("dates", X.date_parts(date, F.col("y"), F.col("m"), F.col("day"))).where("pmid is not null and pmid not in ('', 'nan') and not (d = '' and y = '')")
    return last_wins(parts.select("pmid", "dates", "ord"), ["pmid"], ["ord"]).select("pmid", "dates")


def cached_records(spark: SparkSession, path: str, older: str | None = None) -> DataFrame:
    """(pmid, record), the last line of each id; bad lines, ids without value and null records go.

    ``older``: a second file whose lines come after those of the first.
    """
    found = None
    for k, p in enumerate(x for x in (path, older) if x and exists(spark, x)):
        lines = with_order(spark.read.text(p)).select(F.from_json("value", S.CACHED).alias("r"), F.struct(F.lit(k).alias("source"), "ord").alias("ord"))
        found = lines if found is None else found.unionByName(lines)
    if found is None:
        return empty(spark, S.CACHED)
    rows = found.select("r.pmid", "r.record", "ord").where("pmid is not null and pmid <> ''")
    return last_wins(rows, ["pmid"], ["ord"]).where("record is not null").select("pmid", "record")


def all_records(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, record, ord): every line, in order; a bad line is an error, empty records go."""
    rows = with_order(spark.read.schema(S.CACHED).json(path, mode="FAILFAST"))
    return rows.where("record is not null and pmid is not null")


def key_values(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value), the last line of each key; a null value is kept, as it says "known to be absent"."""
    if not exists(spark, path):
        return empty(spark, f"key STRING, value {value}")
    rows = with_order(spark.read.text(path)).select(F.from_json("value", f"key STRING, value {value}").alias("r"), "ord")
    return last_wins(rows.select("r.key", "r.value", "ord").where("key is not null"), ["key"], ["ord"]).select("key", "value")


def _texts(c: str) -> Column:
    return F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def descriptors(spark: SparkSession, path: str) -> DataFrame:
    """(dui, name, tree_numbers) of a vocabulary's descriptors; records without id or name go."""
    schema = "DescriptorUI STRING, DescriptorName STRUCT<String: STRING>, TreeNumberList STRUCT<TreeNumber: ARRAY<STRING>>"
    rows = spark.read.schema(schema).option("rowTag", "DescriptorRecord").xml(path)
    return rows.select(F.col("DescriptorUI").alias("dui"), F.col("DescriptorName.String").alias("name"), _texts("TreeNumberList.TreeNumber").alias("tree_numbers")).where("dui is not null and name is not null")


def supplements(spark: SparkSession, path: str) -> DataFrame:
    """(scr, name, mapped_dui) of supplementary concepts; records without id or name go."""
    mapped = "HeadingMappedToList STRUCT<HeadingMappedTo: ARRAY<STRUCT<DescriptorReferredTo: STRUCT<DescriptorUI: STRING>>>>"
    rows = spark.read.schema(f"SupplementalRecordUI STRING, SupplementalRecordName STRUCT<String: STRING>, {mapped}").option("rowTag", "SupplementalRecord").xml(path)
    return rows.select(F.col("SupplementalRecordUI").alias("scr"), F.col("SupplementalRecordName.String").alias("name"), _texts("HeadingMappedToList.HeadingMappedTo.DescriptorReferredTo.DescriptorUI").alias("mapped_dui")).where("scr is not null and name is not null")


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """(term_id, name, namespace, parents) of the terms of an OBO file that aren't obsolete; the last stanza of an id wins."""
    stanzas = with_order(spark.read.text(path, lineSep="\n\n")).select(F.split("value", "\r?\n").alias("lines"), "ord")
    stanzas = stanzas.withColumn("lines", F.filter("lines", lambda x: x != ""))
    # text before the first stanza may touch it
    begin = F.array_position("lines", "[Term]")
    body = stanzas.where(begin > 0).withColumn("lines", F.slice("lines", begin.cast("int") + 1, F.size("lines")))
    value = lambda key: F.try_element_at(F.transform(F.filter("lines", lambda x: x.startswith(f"{key}: ")), lambda x: X.strip(F.substring(x, len(key) + 3, 1 << 30))), F.lit(-1))
    parents = F.transform(F.filter("lines", lambda x: x.startswith("is_a: ")), lambda x: X.strip(F.substring_index(F.substring(x, 7, 1 << 30), "!", 1)))
    rows = body.select(value("id").alias("term_id"), value("name").alias("name"), F.coalesce(value("namespace"), F.lit("")).alias("namespace"), parents.alias("parents"), F.exists("lines", lambda x: x.startswith("is_obsolete: true")).alias("obsolete"), "ord")
    rows = rows.where("term_id is not null and not obsolete").withColumn("name", F.coalesce("name", "term_id"))
    return last_wins(rows.drop("obsolete"), ["term_id"], ["ord"]).drop("ord")


def _cells(spark: SparkSession, path: str) -> DataFrame:
    return with_order(spark.read.text(path)).select(F.split(F.regexp_replace("value", "\r$", ""), "\t", -1).alias("c"), "ord")


def gene_terms(spark: SparkSession, path: str, tax_id: str = "9606") -> DataFrame:
    """Distinct (gene_id, class_id) of one organism from the first three columns of a gene-to-term file."""
    c = _cells(spark, path).where(F.size("c") >= 3)
    tax = F.regexp_replace(F.get("c", F.lit(0)), "^#+", "")
    return c.where(tax == tax_id).select(F.get("c", F.lit(1)).alias("gene_id"), F.get("c", F.lit(2)).alias("class_id")).distinct()


def gene_groups(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, path_parts, ord) of gene groups: locus group, then group, a row for each; the locus group alone where there is none."""
    rows = with_order(spark.read.csv(path, sep="\t", header=True, quote=""))
    locus = F.when(X.strip(F.coalesce("locus_group", F.lit(""))) == "", F.lit("Unclassified")).otherwise(X.strip("locus_group"))
    groups = X.subjects_list("gene_group")
    parts = F.when(F.size(groups) == 0, F.array(F.array(locus))).otherwise(F.transform(groups, lambda g: F.array(locus, g)))
    return rows.select(X.strip(F.coalesce("entrez_id", F.lit(""))).alias("gene_id"), F.explode(parts).alias("path_parts"), "ord").where("gene_id <> ''")


def pathway_outline(spark: SparkSession, path: str) -> DataFrame:
    """(class_id, path_parts) of an indented outline: A and B headings, then C lines with a five-digit id.

    Headings are carried down from range to range of lines.  A new A forgets B;
    lines without text are no headings.
    """
    line = with_order(spark.read.text(path)).withColumn("depth", F.substring("value", 1, 1)).where("depth in ('A', 'B', 'C', 'D')")
    line = line.withColumn("rest", X.strip(X.strip_tags(X.strip(F.substring("value", 2, 1 << 30))))).where("rest <> ''")
    heading = lambda depth: F.when(F.col("depth") == depth, F.col("rest"))
    below_a = F.when(F.col("depth").isin("A", "B"), F.struct(heading("B").alias("b")))  # of an A: nothing
    line = carry_down(line, {"a": heading("A"), "below_a": below_a}, ["ord"]).withColumn("b", F.col("below_a.b"))
    found = line.where("depth = 'C'").withColumn("class_id", F.regexp_extract("rest", r"^(\d{5})\s+(.+)", 1)).where("class_id <> ''")
    name = X.strip_trailing_note(F.regexp_extract("rest", r"^(\d{5})\s+(.+)", 2))
    parts = F.filter(F.array("a", "b", name), lambda x: x.isNotNull() & (x != ""))
    return last_wins(found.select("class_id", parts.alias("path_parts"), "ord"), ["class_id"], ["ord"]).drop("ord")


def gene_links(spark: SparkSession, path: str, organism: str = "hsa") -> DataFrame:
    """Distinct (gene_id, class_id) of tab-separated links, without the organism's prefixes."""
    value = spark.read.text(path).select(X.strip("value").alias("v")).where(F.col("v").contains("\t"))
    gene = X.strip_organism(F.substring_index("v", "\t", 1), organism)
    target = F.replace(F.regexp_replace("v", "^[^\t]*\t", ""), F.lit(f"path:{organism}"), F.lit(""))
    return value.select(gene.alias("gene_id"), target.alias("class_id")).where("gene_id <> '' and class_id <> ''").distinct()


def gene_types(spark: SparkSession, path: str, tax_id: str = "9606") -> DataFrame:
    """(gene_id, class_id): the type of each gene of an organism, the last line of a gene; columns by header, else 1st, 2nd and 10th."""
    head = [x.strip() for x in spark.read.text(path).limit(1).first()[0].lstrip("#").split("\t")]
    wanted = ("tax_id", "GeneID", "type_of_gene")
    tax, gene, kind = (head.index(x) for x in wanted) if all(x in head for x in wanted) else (0, 1, 9)
    c = _cells(spark, path).where((F.size("c") > max(tax, gene, kind)) & (F.get("c", F.lit(tax)) == tax_id))
    rows = c.select(F.get("c", F.lit(gene)).alias("gene_id"), F.get("c", F.lit(kind)).alias("class_id"), "ord")
    return last_wins(rows, ["gene_id"], ["ord"]).drop("ord")


def table(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with a header, all strings, blanks for nulls, with ``ord``."""
    rows = with_order(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    return rows.na.fill("", [c for c in rows.columns if c != "ord"])


def ok_documents(spark: SparkSession, path: str) -> DataFrame:
    """The document table's rows with status ok and an id, the last of each id."""
    return last_wins(table(spark, path).where("fetch_status = 'ok' and pmid <> ''"), ["pmid"], ["ord"]).drop("ord")


def existing_output(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return empty(spark, S.DOCUMENTS)
    return last_wins(table(spark, path).where("pmid <> ''"), ["pmid"], ["ord"]).drop("ord")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(pmid): one id a line, trimmed, blank lines left out."""
    return spark.read.text(path).select(X.strip("value").alias("pmid")).where("pmid <> ''")


TREE_FIELDS = ("mesh_id", "gene_id", "web_id", "tree_id", "count(*)", "first")


def bundle(spark: SparkSession, path: str, extra: tuple[str, ...] = (), split: int = json_array.SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """The tree and the docs of a bundle, with ``ord``, ascending in their order; counts stay text.

    Both arrays are read by ranges of ``split`` bytes, and filters of the id reach
    the reader.  In a store that only Spark's readers know, a bundle is one value
    that one task parses.  ``extra``: more document fields to read, as strings.
    """
    fields = dict.fromkeys((*S.BUNDLE_COLUMNS, *S.BLANK_BUNDLE_COLUMNS, "abstract", *extra))
    if json_array.readable(path):
        tree, docs = json_array.read_arrays(spark, path, {"tree": list(TREE_FIELDS), "docs": list(fields)}, split)
    else:
        struct = lambda names: ", ".join(f"`{c}`: STRING" for c in names)
        read = spark.read.schema(f"tree ARRAY<STRUCT<{struct(TREE_FIELDS)}>>, docs ARRAY<STRUCT<{struct(fields)}>>").json(path, multiLine=True)
        tree, docs = (read.select(F.posexplode(c).alias("ord", "x")).select("ord", "x.*") for c in ("tree", "docs"))
    return tree.withColumnRenamed("count(*)", "count").withColumnRenamed("first", "path"), docs


def wanted_docs(docs: DataFrame, ids: DataFrame, most: int = 1000) -> DataFrame:
    """The rows whose id is wanted: few ids are a filter, which reaches the reader of a bundle, more a semi-join."""
    few = [r.pmid for r in ids.select("pmid").distinct().limit(most + 1).collect()]
    if len(few) <= most:
        return docs.where(F.col("pmid").isin(few))
    return docs.join(ids.select("pmid").distinct(), "pmid", "left_semi")


def matching_docs(docs: DataFrame, ids: DataFrame, fields: tuple[str, ...] = ("cat", "hard_category", "format")) -> DataFrame:
    """(pmid, fields) of the documents whose id is wanted and of which any field is filled, the last of each id."""
    any_filled = F.greatest(*((X.first_filled(c) != "") for c in fields))
    found = wanted_docs(docs, ids).where(any_filled)
    return last_wins(found.select("pmid", *fields, "ord"), ["pmid"], ["ord"]).drop("ord")


def response_records(raw: Column) -> Column:
    """The records of a response body: a wrapper object with a list, a bare list, or one record."""
    many = f"ARRAY<{S.RECORD}>"
    wrapped = F.from_json(raw, f"{WRAPPER} {many}")[WRAPPER]
    one = F.from_json(raw, S.RECORD)
    return F.when(F.ltrim(raw).startswith("["), F.from_json(raw, many)).when(raw.contains(f'"{WRAPPER}"'), F.coalesce(wrapped, F.array().cast(many))).otherwise(F.array(one))


def response_variants(raw: Column) -> Column:
    """The records of a response body as variants, every field kept: a wrapper object with a list, a bare list, or one object; none of anything else."""
    value = F.try_parse_json(raw)
    none = F.array().cast("array<variant>")
    inside = F.try_variant_get(value, f"$.{WRAPPER}", "variant")
    kind = F.schema_of_variant(value)
    many = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), none)
    return F.when(value.isNull(), none).when(kind.startswith("ARRAY"), many(value)).when(kind.startswith("OBJECT") & inside.isNotNull(), many(inside)).when(kind.startswith("OBJECT"), F.array(value)).otherwise(none)


def variant_id(record: Column) -> Column:
    """A record's pmid, else its id, as text; null if it has none."""
    return F.coalesce(*(X.blank_to_null(F.try_variant_get(record, f"$.{k}", "string")) for k in ("pmid", "id")))


def as_record(record: Column) -> Column:
    """A variant as the struct that the document table is built from; its other fields stay in the variant."""
    return F.from_json(F.to_json(record), S.RECORD)


def cached_variants(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, record) of a cache of JSON lines (pmid, record), the last line of each id, every field of a record kept; bad lines and null records go."""
    if not exists(spark, path):
        return empty(spark, "pmid STRING, record VARIANT")
    line = with_order(spark.read.text(path)).select(F.try_parse_json("value").alias("v"), "ord").where("v is not null")
    # a variant can't be compared, so it travels beside the order, not within it
    rows = line.select(F.try_variant_get("v", "$.pmid", "string").alias("pmid"), F.try_variant_get("v", "$.record", "variant").alias("record"), "ord").where("pmid is not null and pmid <> ''")
    last = rows.groupBy("pmid").agg(F.max_by("record", "ord").alias("record"))
    return last.where("record is not null and not is_variant_null(record)")


def result_table(spark: SparkSession, path: str, result_format: str = "csv") -> DataFrame:
    """What a registered result shows: a bundle's tree or docs, or a CSV without its empty lines."""
    if result_format in ("json-tree", "json-docs"):
        return bundle(spark, path)[result_format == "json-docs"].drop("ord")
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def approaches(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Trees and docs of several bundles, each row with its ``approach``."""
    trees, docs = None, None
    for name, path in paths.items():
        t, d = (x.withColumn("approach", F.lit(name)) for x in bundle(spark, path))
        trees, docs = (t, d) if trees is None else (trees.unionByName(t), docs.unionByName(d))
    return trees, docs
