"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Base patterns (assignments, access keys, hex runs) are found in every whole
text, with code point positions: the text is split by the pattern, and the
lengths of gaps and matches add up to the starts. A wider pattern finds token
candidates that no base pattern names.

Every candidate value is hashed, and counted over the corpus by distinct
repositories (documents) and owners (sources), with map-side combine on
(hash, owner, repository). A value that many owners hold is a copied example;
one that few owners hold and that looks live (letters and digits, many
different characters) is an owner's credential. Token candidates of the
second kind that touch no base span are added as spans of kind ``owned``.

Matches of all documents are rows (document, kind, number), never an array of
unbounded size until one document's own spans are joined at the end; a value
with a third of all rows is only a large key of a join whose other side has
one row for it, which Spark splits.

Defined results: null and empty texts have no spans; null owners count as one
owner; repeated rows are documents of their own (equal ids are one
repository); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gable.llm.common import materialise, table

# fixed values: kind, pattern, group with the secret, least length of that group
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
OWNED = ("owned", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+", 0, 20)
# what a text must hold for a kind to match at all; spares most texts the split
_FAST = {"assign": KINDS[0][1], "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}", "owned": OWNED[1]}


def _matches(kind: tuple, text: Column) -> Column:
    """array<kind, number, gap before, value, secret> of one pattern, in order."""
    name, pattern, group, _ = kind
    no = [k[0] for k in (*KINDS, OWNED)].index(name)
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secrets = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), secrets.alias("secret")),
                       lambda x, i: F.struct(F.lit(no).alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                             F.length(x["hit"]).alias("n"), x["secret"].alias("secret")))
    return F.when(F.rlike(text, F.lit(_FAST[name])), rows)


def find_matches(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> tuple[DataFrame, DataFrame]:
    """(documents: row id and doc_id, matches: row id, doc_id, owner, kind, start, stop, secret)."""
    text = F.col("text")
    kinds = [_matches(k, text) for k in (*KINDS, OWNED)]
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,n:int,secret:string>>")
    # written before it is used twice, so the row ids stay what they are
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                       .select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner",
                               F.concat(*[F.coalesce(k, empty) for k in kinds]).alias("m")))
    each = rows.where(F.size("m") > 0).select("row", "doc_id", "owner", F.explode("m").alias("m")).select(
        "row", "doc_id", "owner", "m.*")
    stop = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("row", "kind").orderBy("i"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in (*KINDS, OWNED)]), F.col("kind") + 1)
    found = each.withColumn("stop", stop).where(F.length("secret") >= least)
    return rows.select("row", "doc_id"), found.select(
        "row", "doc_id", "owner", "kind", (F.col("stop") - F.col("n")).alias("start"), "stop", "secret")


def ownership(matches: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every secret (by hash), over the corpus."""
    value = F.sha2(F.col("secret").cast("binary"), 256).alias("value")
    by_repository = matches.groupBy(value, "owner", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repository.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"),
                                         F.sum("repositories").alias("repositories"))


def looks_live(secret: Column, distinct_characters: int = 10) -> Column:
    """Letters and digits, and not a pattern of few characters."""
    return (secret.rlike("[0-9]") & secret.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(secret, ""))) >= distinct_characters))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         max_owners: int = 2) -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc_id; spans: row, kind, start, stop, owners, repositories, verdict, reported).

    The verdict is ``example`` (more than ``max_owners`` owners), ``live`` or
    ``dull`` (few owners, but not live-looking).
    """
    rows, matches = find_matches(docs, id_col, text_col, owner_col)
    matches = materialise(matches)
    counts = ownership(matches)
    m = matches.withColumn("value", F.sha2(F.col("secret").cast("binary"), 256)).join(counts, "value", "left")
    verdict = F.when(F.col("owners") > max_owners, "example").when(looks_live(F.col("secret")), "live").otherwise("dull")
    base = F.col("kind") < len(KINDS)
    order = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(base, F.col("stop"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    apart = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("stop"), F.lit(True))
    spans = m.withColumn("verdict", verdict).withColumn("apart", apart)
    return rows, spans.withColumn("reported", base | (F.col("apart") & (F.col("verdict") == "live"))).select(
        "row", "kind", "start", "stop", "owners", "repositories", "verdict", "reported")


def span_report(docs: DataFrame, **options) -> DataFrame:
    """One row a document: counts of base spans, digest of base spans, all spans."""
    rows, spans = scan(docs, **options)
    names = F.array(*[F.lit(k[0]) for k in (*KINDS, OWNED)])
    joined = lambda part: F.array_join(F.transform(part, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")
    base = F.filter("s", lambda s: s["kind"] < len(KINDS))
    found = (spans.where("reported").groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "verdict"))).alias("s")))

    def n(field: str, value) -> Column:
        count = F.size(F.filter("s", lambda s: s[field] == value))
        return F.when(F.col("s").isNull(), 0).otherwise(count).cast("long")

    return rows.join(found, "row", "left").select(
        "doc_id", *[n("kind", no).alias(f"n_{k[0]}") for no, k in enumerate(KINDS)],
        F.sha2(F.coalesce(joined(base), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("s")), F.lit("")).alias("spans"),
        *[n("verdict", v).alias(f"n_{v}") for v in ("live", "example")])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(table(spark, sf_dir, "documents"))
