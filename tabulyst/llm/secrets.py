"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Base patterns find assignments of credentials, access key ids and long hex strings; a further one
finds mixed tokens of high variety. The value of every candidate is hashed, and distinct repositories
and owners of each hash are counted over the whole corpus: what many owners share is a copied example, what
one or few owners have looks live. Mixed tokens become spans only if they look live; spans of
the base patterns always stay, with their verdict.

Positions: splitting a text by a pattern gives what lies between its matches, so the running sum of the
lengths of both is the place of each match. It is summed in a window of one document's matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, pick

#: A value in more distinct repositories or owners than this is an example that was copied.
OWNERS = 3
MASK = "[SECRET]"

# The patterns, (kind, pattern, least characters, group whose length counts and which is the value).
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (
    ("assign", ASSIGN, 8, 2),
    ("access", r"AKIA[A-Z0-9]{12,}", 16, 0),
    ("hex", r"[0-9a-f]{32,}", 32, 0),
    ("mixed", r"[A-Za-z0-9_-]{24,}", 24, 0),
)
BASE = ("assign", "access", "hex")


def _maybe(text: Column) -> dict[str, Column]:
    """Per kind whether a text can have a match long enough, at the price of one search."""
    return {
        "assign": text.rlike(ASSIGN[:-2] + "{8})"),
        "access": text.rlike(r"AKIA[A-Z0-9]{12}"),
        "hex": text.rlike(r"[0-9a-f]{32}"),
        "mixed": text.rlike(r"[A-Za-z0-9_-]{24}"),
    }


def _matches(texts: DataFrame) -> DataFrame:
    """(doc_id, version, repo, owner, kind, start, end, value) of all matches; one row per (doc_id, version) comes in."""
    keys, out = ["doc_id", "version", "repo", "owner"], None
    place = Window.partitionBy("doc_id", "version", "kind").orderBy("i")
    for kind, pattern, least, group in PATTERNS:
        found = texts.where(F.col(kind)).select(
            *keys, F.lit(kind).alias("kind"),
            F.posexplode(F.arrays_zip(
                F.split("text", pattern, -1).alias("before"),
                F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("whole"),
                F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
            )).alias("i", "m"),
        ).select(*keys, "kind", "i", F.length("m.before").alias("gap"), F.length("m.whole").alias("size"), F.col("m.value").alias("value")).where("size IS NOT NULL")
        out = found if out is None else out.union(found)
    out = out.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(place).cast("bigint"))
    out = out.withColumn("start", F.col("end") - F.col("size"))
    least = F.create_map(*[F.lit(x) for kind, _, n, _ in PATTERNS for x in (kind, n)])
    varied = F.col("value").rlike("[0-9].*[0-9].*[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    return out.where((F.length("value") >= least[F.col("kind")]) & ((F.col("kind") != "mixed") | varied)).select(*keys, "kind", "start", "end", "value")


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """Every span: (doc_id, version, kind, start, end, n_repos, n_owners, live); code points, end exclusive.

    `version` is a hash of the text: rows equal in id and text are one document. A null repository or
    owner counts as one of its own kind. Null and empty texts have no span.
    """
    stages = Stages(docs.sparkSession)
    plain = pick(docs, {"doc_id": doc_id, "text": text, "repo": repo, "owner": owner})
    marked = plain.withColumn("version", F.xxhash64("text")).withColumns(_maybe(F.col("text")))
    kinds = [kind for kind, *_ in PATTERNS]
    some = marked.where(F.greatest(*[F.col(x).cast("int") for x in kinds]) == 1)
    # One text may lie in several repositories under one id; spans are found once, owners are counted for each.
    copies = stages.keep(some, "candidates")
    one = copies.groupBy("doc_id", "version").agg(*[F.min(x).alias(x) for x in ("text", "repo", "owner", *kinds)])
    found = stages.keep(_matches(one).withColumn("hash", F.sha2("value", 256)).drop("value", "repo", "owner"), "matches")
    held = copies.select("doc_id", "version", F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"))
    same = F.col("f.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("f.version") == F.col("h.version"))
    owned = found.select("doc_id", "version", "hash").distinct().alias("f").join(held.distinct().alias("h"), same)
    counts = owned.groupBy("hash").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"))
    counts = stages.keep(counts, "owners")
    live = (F.col("n_repos") <= owners) & (F.col("n_owners") <= owners)
    spans = found.join(counts, "hash").withColumn("live", live).drop("hash")
    base = spans.where(F.col("kind") != "mixed")
    # A mixed token that a base span covers in part or whole adds nothing.
    added = spans.where((F.col("kind") == "mixed") & F.col("live")).alias("a")
    other = base.select("doc_id", "version", "start", "end").alias("b")
    meets = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.version") == F.col("b.version")) & (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end"))
    return stages.keep(base.unionByName(added.join(other, meets, "left_anti")), "spans")


def _per_document(spans: DataFrame) -> DataFrame:
    """Spans of each document, by start and then by kind in the order of the patterns."""
    rank = F.array_position(F.array(*[F.lit(kind) for kind, *_ in PATTERNS]), F.col("kind"))
    listed = F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "live")))
    return spans.groupBy(F.col("doc_id").alias("d"), F.col("version").alias("v")).agg(listed.alias("s"))


def _with_spans(plain: DataFrame, spans: DataFrame, *columns) -> DataFrame:
    found = _per_document(spans)
    return plain.join(found, plain["doc_id"].eqNullSafe(found["d"]) & plain["version"].eqNullSafe(found["v"]), "left").select(*columns)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """One row per document: doc_id, spans as array, counts by kind, digest, and verdicts.

    Documents without a span have counts of 0 and an empty list. Extra columns are ignored, whatever their names.
    """
    spans = secret_spans(docs, doc_id, text, repo, owner, owners)
    plain = pick(docs, {"doc_id": doc_id, "text": text}).select("doc_id", F.xxhash64("text").alias("version"))
    named = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    rows = _with_spans(plain, spans, "doc_id", F.coalesce("s", F.expr("filter(array(named_struct('start', 0L, 'rank', 0L, 'kind', '', 'end', 0L, 'live', true)), x -> false)")).alias("s"))
    of = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter("s", lambda x: x["kind"] != "mixed")
    return rows.select(
        "doc_id", *[of(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("s", named), ",").alias("spans"),
        F.size(F.filter("s", lambda x: x["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("s", lambda x: ~x["live"])).cast("bigint").alias("n_copied"),
    )


def _merged(spans: str) -> Column:
    """Spans in order as (start, end), those that touch or overlap as one."""
    return F.aggregate(
        spans, F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """docs, all columns, with every span of the text replaced by a mask; texts without a span stay as they are."""
    spans = secret_spans(docs, doc_id, text, repo, owner, owners)
    names = docs.columns
    at, of = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumns({"doc_id": F.col(of), "version": F.xxhash64(at)})
    columns = [f"c{i}" for i in range(len(names))]
    rows = _with_spans(plain, spans, *columns, F.col("s")).withColumn("s", F.when(F.size("s") > 0, _merged("s")))
    cut = F.concat(
        F.array_join(F.transform("s", lambda x, i: F.concat(
            F.substring(F.col(at), F.when(i > 0, F.element_at("s", i)["end"]).otherwise(0).cast("int") + 1, (x["start"] - F.when(i > 0, F.element_at("s", i)["end"]).otherwise(0)).cast("int")),
            F.lit(MASK))), ""),
        F.substring(F.col(at), F.element_at("s", -1)["end"].cast("int") + 1, F.length(at)))
    return rows.withColumn(at, F.when(F.col("s").isNotNull(), cut).otherwise(F.col(at))).select(*columns).toDF(*names)
