"""Readers of landed files and pages; every reader returns one fixed schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.functions.payload import key_paths
from tendersift.functions.text import find_column, strip
from tendersift.operators.notices import conform
from tendersift.schema import POSTING, POSTING_SOURCE_NAMES
from tendersift.scale import BUCKET_WIDTH, keep_first
from tendersift.session import cut_lineage


def cached_postings(spark: SparkSession, path: str, source: str) -> DataFrame:
    """SRC1: a JSON array (or lines) of cached postings; absent keys are null, an empty flag is false."""
    fields = sorted({*POSTING_SOURCE_NAMES, "url", "posted_relative", "mission", "source"})
    raw = spark.read.schema(",".join(f"`{f}` string" for f in fields)).option("multiLine", True).json(path)
    ours = {POSTING_SOURCE_NAMES.get(f, f): F.col(f) for f in fields}
    for flag in ("closed", "reposted", "open_confirmed"):
        ours[flag] = ~F.coalesce(F.lower(ours[flag]), F.lit("")).isin("", "false", "0")
    ours["applicants"] = ours["applicants"].try_cast("int")
    ours["source"] = F.coalesce(F.nullif(ours["source"], F.lit("")), F.lit(source))
    ours["seq"] = F.monotonically_increasing_id()
    return conform(raw, POSTING, **ours)


def paged_payload(pages: DataFrame, payload: str, array_path: str, element: str, key: str, page_no: str) -> DataFrame:
    """SRC2: landed pages, one payload per row, to the records of the array at `array_path` (a key).

    The first record of a repeated key counts, in page order.
    """
    schema = f"struct<`{array_path}`:array<{element}>>"
    d = (pages.select(page_no, F.from_json(payload, schema)[array_path].alias("_a"))
         .select(page_no, F.posexplode("_a").alias("_pos", "_r")).select(page_no, "_pos", "_r.*"))
    return keep_first(d, [key], [page_no, "_pos"]).drop("_pos")


def json_ld(pages: DataFrame, kind: str) -> DataFrame:
    """SRC5: the first JSON-LD block of a page with the given `@type`, as JSON text."""
    blocks = F.regexp_extract_all("html", F.lit(
        r'(?is)<script[^>]*type\s*=\s*["\']application/ld\+json["\'][^>]*>(.*?)</script>'), 1)
    typed = F.filter(blocks, lambda b: F.coalesce(F.get_json_object(b, "$['@type']") == kind, F.lit(False)))
    return pages.select("page_id", "url", F.get(typed, F.lit(0)).alias("posting")).filter("posting IS NOT NULL")


def rss_items(feeds: DataFrame, xml: str = "xml", key: str = "page_id") -> DataFrame:
    """SRC6: items of landed RSS documents; a malformed document has no items."""
    item = "struct<title:string,link:string,pubDate:string,guid:string>"
    whole = F.from_xml(F.col(xml), f"struct<channel:struct<item:array<{item}>>>", {"mode": "PERMISSIVE"})
    usable = F.col(xml).rlike(r"(?s)^\s*(?:<\?xml.*?\?>\s*)?<rss\b.*</rss>\s*$")
    return (feeds.withColumn("_f", F.when(usable, whole)).select(key, F.posexplode("_f.channel.item").alias("pos", "_i"))
            .select(key, "pos", "_i.title", "_i.link", F.col("_i.pubDate").alias("pub_date"), "_i.guid"))


def profile_blocks(spark: SparkSession, path: str, topic_prefixes: Sequence[str] = L.TOPIC_PREFIXES) -> DataFrame:
    """SRC7: blocks of a text file: `#` lines dropped, split on blank lines, topic blocks marked."""
    kept = F.array_join(F.filter(F.split("value", r"\r?\n"), lambda x: ~F.startswith(F.ltrim(x), F.lit("#"))), "\n")
    blocks = F.filter(F.transform(F.split(kept, r"\n\s*\n"), strip), lambda b: b != "")
    d = spark.read.text(path, wholetext=True).select(F.posexplode(blocks).alias("block_id", "text"))
    topic = F.lit(False)
    for p in topic_prefixes:
        topic = topic | F.upper(F.col("text")).startswith(p)
    return d.withColumn("is_topic", topic)


def table_by_position(spark: SparkSession, path: str, layout: Mapping[str, int], key: str, header_words: Sequence[str]) -> DataFrame:
    """SRC8: a CSV tab read by column position; blank and header rows skipped."""
    width = max(layout.values()) + 1
    raw = spark.read.schema(",".join(f"c{i} string" for i in range(width))).option("mode", "PERMISSIVE").csv(path)
    d = raw.select(*[F.col(f"c{i}").alias(n) for n, i in layout.items()])
    k = F.lower(F.trim(F.coalesce(F.col(key), F.lit(""))))
    return d.filter((k != "") & ~k.isin(*[w.lower() for w in header_words]))


def carry_header(df: DataFrame, doc: str, row_no: str, header: str, out: str, width: int = BUCKET_WIDTH) -> DataFrame:
    """WIN8: the last header at or before each row of its document.

    A document may be long: rows are cut into blocks of `width` row numbers, and only each block's
    last header is carried from block to block.
    """
    d = df.withColumn("_block", F.floor(F.col(row_no) / width))
    inside = Window.partitionBy(doc, "_block").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(doc).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = d.filter(F.col(header).isNotNull()).groupBy(doc, "_block").agg(F.max_by(header, row_no).alias("_h"))
    blocks = d.select(doc, "_block").distinct().join(last, [doc, "_block"], "left")
    carry = blocks.select(doc, "_block", F.last("_h", ignorenulls=True).over(before).alias("_carry"))
    return (d.withColumn("_in", F.last(header, ignorenulls=True).over(inside)).join(carry, [doc, "_block"])
            .withColumn(out, F.coalesce("_in", "_carry")).drop("_block", "_in", "_carry"))


def table_rows(rows: DataFrame, header_prefix: str) -> DataFrame:
    """SRC9: extracted rows (doc, row_no, cells) to maps header -> value; the header row may repeat or
    change, short rows are dropped, rows before the first header too."""
    from tendersift.functions.text import fold
    first = F.exists("cells", lambda c: F.startswith(fold(c), F.lit(header_prefix)))
    d = rows.withColumn("_h", F.when(first, F.col("cells")))
    d = carry_header(d, "doc", "row_no", "_h", "header").filter(F.col("_h").isNull() & F.col("header").isNotNull())
    d = d.filter(F.size("cells") >= F.size("header"))
    values = F.transform(F.slice("cells", F.lit(1), F.size("header")), lambda x: strip(F.coalesce(x, F.lit(""))))
    pairs = F.filter(F.arrays_zip(F.col("header").alias("k"), values.alias("v")), lambda p: F.coalesce(p["k"], F.lit("")) != "")
    return d.select("doc", "row_no", F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"], p["v"]))).alias("record"))


def columns_by_fragment(rows: DataFrame, wanted: Mapping[str, Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Values of a record map under names found by header fragments among the known header names."""
    out = {}
    for name, fragments in wanted.items():
        key = find_column(names, *fragments)
        out[name] = F.col("record")[key] if key else F.lit(None).cast("string")
    return rows.select("doc", "row_no", *[c.alias(n) for n, c in out.items()])


def payload_keys(df: DataFrame, payload: str) -> DataFrame:
    """SRC12: every key path that occurs, with the number of payloads that have it."""
    return (df.select(F.explode(key_paths(F.col(payload))).alias("path")).groupBy("path")
            .agg(F.count(F.lit(1)).alias("n")))


def sniff(content: Column) -> Column:
    """SRC13: kind of a document by its first bytes."""
    head = F.substring(content, 1, 4)
    return (F.when(head == F.lit(b"%PDF"), "pdf").when(F.substring(content, 1, 2) == F.lit(b"PK"), "zip")
            .otherwise("type non supporté"))


def binary_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", sniff(F.col("content")).alias("kind"))


Reader = Callable[[SparkSession], DataFrame]
REGISTRY: dict[str, Reader] = {}
STATUS = T.StructType([T.StructField("source", T.StringType()), T.StructField("ok", T.BooleanType()),
                       T.StructField("error", T.StringType())])


def register(name: str, reader: Reader) -> None:
    """SRC11 and UDF2."""
    REGISTRY[name] = reader


def read_all(spark: SparkSession, names: Sequence[str] | None = None) -> tuple[DataFrame | None, DataFrame]:
    """SRC10: all sources together and a status row each; one failing source does not lose the others.

    Every source is written to a table of its own first, so an unreadable file is that source's failure and
    not the union's. `seq`, where the sources have it, is numbered anew over the union: by source in the
    given order, then as the source was read.
    """
    parts, status = [], []
    for name in names or sorted(REGISTRY):
        try:
            parts.append(cut_lineage(REGISTRY[name](spark)))
            status.append((name, True, None))
        except Exception as e:  # noqa: BLE001 - reported per source
            status.append((name, False, f"{type(e).__name__}: {e}"))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    if out is not None and "seq" in out.columns:
        out = cut_lineage(out.withColumn("seq", F.monotonically_increasing_id()))
    return out, spark.createDataFrame(status, STATUS)
