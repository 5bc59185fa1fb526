"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import carried, written

# Fixed values of the contract: kinds in their order, patterns, the group that is the secret, its least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32)]

# What the method looks at beside them: long runs that change often between digits, small and capital letters.
OWNED, OWNED_RUN, OWNED_CHANGES = "owned", "[A-Za-z0-9_-]{20,}", 6
WIDE_OWNERS, WIDE_REPOSITORIES = 3, 20  # a value that so many owners, or so many repositories, hold is a copied example

SPAN = "struct<start:int, rank:int, kind:string, stop:int, digest:string>"
KEY = ["_doc", "_text_hash"]


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of all matches whose group is long enough, left to right.

    What the pattern splits the text into, and the matches between, give the positions as running lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("before"), whole.alias("whole"), secret.alias("secret"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["before"])
        stop = start + F.char_length(x["whole"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop"),
            F.md5(x["secret"]).alias("digest"),
        )
        good = F.char_length(x["secret"]) >= least
        found = F.when(good, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(stop.alias("at"), found.alias("found"))

    none = F.array().cast(f"array<{SPAN}>")
    matched = F.filter(pairs, lambda x: x["whole"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    spans = F.aggregate(matched, start, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _changes(value: Column) -> Column:
    return F.char_length(F.regexp_replace(value, "[0-9]+|[a-z]+|[A-Z]+", "x"))


def _owned(text: Column) -> Column:
    """Candidate spans of the method: long runs with a digit, a letter and many changes between them."""
    spans = _spans(text, len(BASE), OWNED, OWNED_RUN, 0, 20)

    def likely(x: Column) -> Column:
        value = F.substring(text, x["start"] + 1, x["stop"] - x["start"])
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (_changes(value) >= OWNED_CHANGES)

    return F.filter(spans, likely)


def _listed(spans: Column) -> Column:
    each = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"]))
    return F.array_join(each, ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """``digest``, ``owners``, ``repositories`` of each value, from (digest, owner, repository) rows.

    Pairs are made distinct with map-side combination before they are counted, so a value that everyone copies
    reaches its counter as one row per owner or repository and task. Null owners and repositories are not counted.
    """
    owners = candidates.select("digest", "owner").distinct().groupBy("digest").agg(F.count("owner").alias("owners"))
    held = candidates.select("digest", "repository").distinct()
    return owners.join(held.groupBy("digest").agg(F.count("repository").alias("repositories")), "digest")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Secrets of every text: one row per row of ``docs``, with ``doc_id`` and the columns named in ``carry``, which
    may have any name, behind those of the scan.

    ``base`` holds the spans of the listed kinds. ``added`` holds other long mixed runs that touch no base span and
    whose value is owner-specific: in the whole corpus fewer than WIDE_OWNERS owners hold it, and fewer than
    WIDE_REPOSITORIES repositories, be they all of one owner. ``live`` are the spans of both whose value is so; other
    base spans are widely copied examples. Spans are (start, rank, kind, stop, digest, owners, repositories), in code
    points with an exclusive end, by start and kind; the last two count who holds the value. Null text reads as empty
    and has no spans; a null owner or repository counts as none. An empty table gives no rows. The columns of ``docs``
    that are not named are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias(KEY[0]),
        F.xxhash64("doc_id", "text").alias(KEY[1]),
        F.col(owner).cast("string").alias("_owner"),
        F.col(repository).cast("string").alias("_repository"),
        text.alias("_text"),
        *carried(carry),
    )
    base = F.array_sort(F.concat(*(_spans(F.col("_text"), i, *kind) for i, kind in enumerate(BASE))))
    rows = rows.withColumn("base", base).withColumn("_owned", _owned(F.col("_text")))
    apart = F.filter(
        "_owned", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"]))
    )
    found = written(rows.withColumn("_owned", apart).drop("_text"), "secrets")

    some = found.filter((F.size("base") > 0) | (F.size("_owned") > 0))
    each = some.select(*KEY, "_owner", "_repository", F.explode(F.concat("base", "_owned")).alias("s"))
    each = each.select(*KEY, F.col("_owner").alias("owner"), F.col("_repository").alias("repository"), "s.digest")
    counted = written(ownership(each), "ownership")
    held = each.select(*KEY, "digest").distinct().join(counted, "digest").groupBy(*KEY)
    held = held.agg(F.map_from_entries(F.collect_list(F.struct("digest", F.struct("owners", "repositories")))).alias("_held"))
    held = written(held, "held")

    def counts(x: Column) -> Column:
        return F.col("_held")[x["digest"]]

    own = lambda x: (counts(x)["owners"] < WIDE_OWNERS) & (counts(x)["repositories"] < WIDE_REPOSITORIES)
    with_counts = lambda spans: F.transform(
        spans, lambda x: x.withField("owners", counts(x)["owners"]).withField("repositories", counts(x)["repositories"])
    )
    out = found.join(held, KEY, "left").withColumn("added", with_counts(F.filter("_owned", own)))
    out = out.withColumn("live", F.array_sort(F.concat(with_counts(F.filter("base", own)), "added")))
    return out.select("doc_id", with_counts(F.col("base")).alias("base"), "added", "live", *carried(carry, back=True))


def report(docs: DataFrame) -> DataFrame:
    """The scan in counts, digests and listed spans; ``n_live`` and ``n_copied`` count spans by ownership, ``owners`` and
    ``repositories`` list how many hold the value of each span. An empty table gives no rows."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", "added"))
    n_live = F.size("live").cast("long")
    return scan(docs).select(
        "doc_id",
        *(count(kind) for kind, *_ in BASE),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        n_live.alias("n_live"),
        (F.size("base") + F.size("added") - n_live).alias("n_copied"),
        F.array_join(F.transform(every, lambda x: x["owners"].cast("string")), ",").alias("owners"),
        F.array_join(F.transform(every, lambda x: x["repositories"].cast("string")), ",").alias("repositories"),
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every live secret in ``text`` replaced by a mark, and ``n_chars``, if it is there, set to the
    length of the new text. Widely copied examples and all other columns stay as they are; null text stays null. An
    empty table gives no rows."""
    names = docs.columns
    found = scan(docs, carry=tuple(names))
    hidden = found.toDF("_id", "_base", "_added", "_live", *names)
    clean = F.when(F.size("_live") > 0, redacted(F.col("text"), F.col("_live"))).otherwise(F.col("text"))
    out = hidden.withColumn("text", clean)
    if "n_chars" in names:
        changed = F.when(F.size("_live") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*names)


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with each stretch covered by ``spans`` (sorted by start) replaced by ``mark``."""

    def step(state: Column, x: Column) -> Column:
        apart = F.concat(
            state["out"], F.substring(text, state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0))), F.lit(mark)
        )
        out = F.when(x["start"] >= state["at"], apart).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["stop"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, end))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
),
raw AS (
  SELECT r, 0 AS rank, 'assign' AS kind, 8 AS least,
    string_split_regex(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS befores,
    regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS wholes,
    regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS secrets
  FROM docs
  UNION ALL
  SELECT r, 1, 'access', 16, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM docs
  UNION ALL
  SELECT r, 2, 'hex', 32, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'),
    regexp_extract_all(text, '[0-9a-f]+') FROM docs
  UNION ALL
  SELECT r, 3, 'owned', 20, string_split_regex(text, '[A-Za-z0-9_-]{20,}'), regexp_extract_all(text, '[A-Za-z0-9_-]{20,}'),
    regexp_extract_all(text, '[A-Za-z0-9_-]{20,}') FROM docs
),
steps AS (
  SELECT r, rank, kind, least, unnest(range(len(wholes))) AS i, unnest(wholes) AS whole, unnest(secrets) AS secret,
    unnest(befores[:len(wholes)]) AS before FROM raw
),
ends AS (
  SELECT *, sum(length(before) + length(whole)) OVER (PARTITION BY r, rank ORDER BY i) AS stop FROM steps
),
spans AS (
  SELECT r, rank, kind, (stop - length(whole))::BIGINT AS start, stop::BIGINT AS stop, secret FROM ends
  WHERE length(secret) >= least AND (rank < 3 OR (
    regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Za-z]')
    AND length(regexp_replace(secret, '[0-9]+|[a-z]+|[A-Z]+', 'x', 'g')) >= 6))
),
base AS (SELECT * FROM spans WHERE rank < 3),
candidates AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM spans s WHERE rank = 3
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = s.r AND b.start < s.stop AND s.start < b.stop)
),
held AS (
  SELECT secret, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repositories
  FROM candidates JOIN docs USING (r) GROUP BY secret
),
kept AS (
  SELECT c.*, owners, repositories, owners >= 3 OR repositories >= 20 AS copied FROM candidates c JOIN held USING (secret)
),
listed AS (
  SELECT r,
    count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3 OR NOT copied) AS spans,
    count(*) FILTER (NOT copied) AS n_live, count(*) FILTER (copied AND rank < 3) AS n_copied,
    string_agg(owners::VARCHAR, ',' ORDER BY start, rank) FILTER (rank < 3 OR NOT copied) AS owners,
    string_agg(repositories::VARCHAR, ',' ORDER BY start, rank) FILTER (rank < 3 OR NOT copied) AS repositories
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(owners, '') AS owners,
  coalesce(repositories, '') AS repositories
FROM docs LEFT JOIN listed USING (r)
"""
