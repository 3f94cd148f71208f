"""Secret scan with corpus-wide ownership: DataFrame and SQL functions only.

1. One pass over the texts finds the base spans (assignments, access keys, hex runs) and bare long tokens. Positions
   come from the text between the matches: the start of match i is the length of everything before it. The result,
   without the texts, is written to the shared folder once.
2. Candidate values are hashed; per hash the distinct repositories and owners are counted (partial aggregates first, so
   a value copied into a third of all documents is no hot key).
3. A value that many owners share is a copied example; one of few owners that looks like a credential is live. Bare
   tokens equal to a live value that some document assigns are added as ``reuse`` spans.

An owner is the part of the repository name before the first ``/``. Defined results: null text is empty text (no
spans); null repositories count as one repository with an empty name; each row is scanned on its own, so repeated rows
get equal results (and do not raise the number of owners); matches that start together go by kind; a text of any length
takes time in proportion to its length and matches; an empty table gives no rows; further columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from ._common import read

# Base patterns; the keyword letters match in either case.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"(AKIA[A-Z0-9]{14,})"          # the same spans as AKIA[A-Z0-9]+ of 18 or more: a run never matches later
HEX = r"([0-9a-f]{16,})"
BARE = r"((?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])[A-Za-z0-9+/_.=-]{12,})"
PATTERNS = {1: (ASSIGN, 2, 12), 2: (ACCESS, 0, 18), 3: (HEX, 0, 16), 4: (BARE, 0, 12)}      # pattern, value's group, least
KINDS = ("assign", "access", "hex", "reuse")
PLACEHOLDER = "(?i)example|sample|placeholder|changeme|dummy|your_|xxxx"
MAX_OWNERS = 2                           # a live value belongs to at most so many owners

CHUNK = 256                              # matches, or characters of a piece, handled at a time
_SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _matches(pattern: str, group: int) -> str:
    """SQL for a pattern's matches in column ``t``: their lengths ``n``, values ``v`` (of ``group``) and the lengths ``gap`` of
    the text before each; null without a match. Positions follow from the lengths."""
    p = "r'" + pattern.replace("'", r"\x27") + "'"
    whole = f"regexp_extract_all(t, {p}, 0)"
    value = whole if group == 0 else f"regexp_extract_all(t, {p}, {group})"
    return (f"IF(t RLIKE {p}, named_struct('n', transform({whole}, m -> char_length(m)), 'v', {value}, "
            f"'gap', transform(split(t, {p}, -1), x -> char_length(x))), null)")


def _spans(kind: int, found: str, least: int) -> str:
    """SQL for the spans of ``_matches`` in column ``found`` whose value has ``least`` characters or more. Running sums are
    taken in chunks of ``CHUNK`` matches and then over the chunks, so the work is linear in the matches."""
    n = f"size({found}.n)"
    each = (f"zip_with(arrays_zip({found}.n, {found}.v), slice({found}.gap, 1, {n}), "
            f"(m, gap) -> struct(gap AS gap, m.n AS n, m.v AS v))")
    chunks = f"transform(sequence(0, ({n} - 1) div {CHUNK}), c -> slice({each}, c * {CHUNK} + 1, {CHUNK}))"
    each_at = (f"aggregate(c, struct(x.at AS at, cast(array() AS {_SPAN}) AS out), (a, m) -> struct(a.at + m.gap + m.n AS at, "
               f"IF(char_length(m.v) >= {least}, concat(a.out, array(named_struct('start', a.at + m.gap, 'kind', {kind}, "
               f"'stop', a.at + m.gap + m.n, 'value', m.v))), a.out) AS out))")
    walk = (f"flatten(aggregate({chunks}, struct(0 AS at, cast(array() AS array<{_SPAN}>) AS out), (x, c) -> "
            f"transform(array({each_at}), y -> struct(y.at AS at, concat(x.out, array(y.out)) AS out))[0], x -> x.out))")
    return f"IF({found} IS NULL, cast(array() AS {_SPAN}), {walk})"


def candidates(docs: DataFrame, text: str = "text", repo: str = "source", whole: bool = False) -> DataFrame:
    """(row, doc_id, repo, base spans, bare tokens) of every row; ``row`` numbers the rows of the written table.
    With ``whole`` the input row comes along as struct ``doc`` instead of its doc_id."""
    d = docs.select(F.struct("*").alias("doc") if whole else F.col("doc_id"),
                    F.coalesce(F.col(repo), F.lit("")).alias("repo"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    mine = "doc" if whole else "doc_id"
    d = d.select(mine, "repo", *[F.expr(_matches(p, g)).alias(f"f{k}") for k, (p, g, _) in PATTERNS.items()])
    spans = {k: _spans(k, f"f{k}", least) for k, (*_, least) in PATTERNS.items()}
    return d.select(F.monotonically_increasing_id().alias("row"), mine, "repo",
                    F.expr(f"array_sort(concat({spans[1]}, {spans[2]}, {spans[3]}))").alias("base"),
                    F.expr(spans[4]).alias("bare"))


def ownership(found: DataFrame) -> DataFrame:
    """Per distinct base value (as a hash): repositories, owners, and whether it looks like a live credential."""
    v = found.select("repo", F.explode("base").alias("s")).select(
        F.md5("s.value").alias("h"), "repo", F.split_part("repo", F.lit("/"), F.lit(1)).alias("owner"),
        (F.col("s.value").rlike("[0-9]") & F.col("s.value").rlike("[A-Za-z]")
         & ~F.col("s.value").rlike(PLACEHOLDER)).alias("looks"))
    v = v.groupBy("h", "repo", "owner", "looks").agg(F.count(F.lit(1)).alias("n"))
    return v.groupBy("h").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"),
                              F.sum("n").alias("n_found"), F.max("looks").alias("looks")).select(
        "h", "n_repos", "n_owners", "n_found", (F.col("looks") & (F.col("n_owners") <= MAX_OWNERS)).alias("live"))


def _judged(found: DataFrame) -> DataFrame:
    """Spans of each row whose value some document has in a base span, with the value's ownership."""
    owned = materialize(ownership(found), "secret-owners")
    each = found.select("row", F.explode("base").alias("s")).select("row", "s", F.lit(True).alias("is_base")).unionByName(
        found.where("size(bare) > 0").select(
            "row", F.explode(F.expr("filter(bare, b -> NOT exists(base, s -> s.start < b.stop AND b.start < s.stop))"))
            .alias("s"), F.lit(False).alias("is_base")))
    judged = each.withColumn("h", F.md5("s.value")).join(owned.select("h", "n_owners", "live"), "h")
    return judged.where("is_base or live")


def secret_spans(docs: DataFrame, text: str = "text", repo: str = "source") -> DataFrame:
    """One row per input row: doc_id, base spans, all spans (with ``reuse`` ones), live and example counts."""
    found = materialize(candidates(docs, text, repo), "secret-candidates")
    judged = _judged(found)
    per = judged.groupBy("row").agg(
        F.sum((F.col("is_base") & F.col("live")).cast("long")).alias("n_live"),
        F.sum((F.col("is_base") & (F.col("n_owners") > MAX_OWNERS)).cast("long")).alias("n_example"),
        F.collect_list(F.when(~F.col("is_base"), F.col("s"))).alias("more"))
    out = found.select("row", "doc_id", "base").join(per, "row", "left")
    return out.select("doc_id", "base", F.expr(f"array_sort(concat(base, coalesce(more, cast(array() AS {_SPAN}))))")
                      .alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"),
                      F.coalesce("n_example", F.lit(0)).alias("n_example"))


def redact(docs: DataFrame, text: str = "text", repo: str = "source", mark: str = "[secret]") -> DataFrame:
    """All rows and columns, the values of live credentials in ``text`` replaced by ``mark`` (copied examples stay)."""
    found = materialize(candidates(docs, text, repo, whole=True), "secret-rows")
    live = _judged(found.select("row", "repo", "base", "bare")).where("live").select(
        "row", F.expr("s.stop - char_length(s.value)").alias("a"), F.col("s.stop").alias("b"))
    # what is kept before each value: from the end of the values so far; a value inside earlier ones is masked already
    before = Window.partitionBy("row").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    live = live.select("row", "a", "b", F.coalesce(F.max("b").over(before), F.lit(0)).alias("at")).where("b > at")
    live = live.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", F.greatest("a", "at").alias("a"), "b"))).alias("cuts"))
    t, size = f"doc.`{text}`", 16 * CHUNK
    # pieces come from slices of the text, as a substring's cost is its distance from the start
    part = lambda lo, hi: (f"concat_ws('', transform(sequence({lo} div {size}, ({hi} - 1) div {size}), k -> substring(slices[k], "  # noqa: E731
                           f"greatest({lo} - k * {size}, 0) + 1, least({hi} - k * {size}, {size}) - greatest({lo} - k * {size}, 0))))")
    kept = f"transform(cuts, c -> concat(IF(c.a > c.at, {part('c.at', 'c.a')}, ''), '{mark}'))"
    rest = f"IF(last < long, {part('last', 'long')}, '')"
    out = found.select("row", "doc").join(live, "row", "left").select(
        "doc", "cuts", F.expr(f"IF(cuts IS NULL, null, regexp_extract_all({t}, '(?s).{{1,{size}}}', 0))").alias("slices"),
        F.expr(f"char_length({t})").alias("long"), F.expr("element_at(cuts, -1).b").alias("last"))
    masked = F.expr(f"IF(cuts IS NULL, {t}, concat(array_join({kept}, ''), {rest}))")
    return out.select(*[masked.alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])


def digest(spans):
    """``kind:start:end`` of a span array, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', element_at({names}, s.kind), s.start, s.stop)), ',')")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets of every document with the corpus-wide ownership of their values."""
    s = secret_spans(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    n = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS long)").alias(c)
         for k, c in ((1, "n_assign"), (2, "n_access"), (3, "n_hex"))]
    return s.select("doc_id", *n, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"),
                    "n_live", "n_example")


# One CTE per kind: pieces between the matches give the positions. Bare tokens need a digit (looked up afterwards).
_ASSIGN_SQL, _BARE_SQL = ASSIGN.replace("'", "''"), "[A-Za-z0-9+/_.=-]{12,}"


def _found_sql(kind: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, {kind} AS kind, v, n, sum(gap + n) OVER (PARTITION BY doc_id ORDER BY i) - n AS b FROM (
    SELECT doc_id, unnest(m) AS m0, unnest(vs) AS v, len(unnest(m)) AS n, len(unnest(list_slice(gaps, 1, len(m)))) AS gap,
           generate_subscripts(m, 1) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS vs,
             string_split_regex(t, '{pattern}') AS gaps FROM d)) QUALIFY len(v) >= {least}"""


OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS repo FROM documents),
base AS ({_found_sql(1, _ASSIGN_SQL, 2, 12)} UNION ALL {_found_sql(2, ACCESS, 1, 18)} UNION ALL {_found_sql(3, HEX, 1, 16)}),
bare AS ({_found_sql(4, _BARE_SQL, 0, 12)}),
own AS (SELECT v, count(DISTINCT split_part(repo, '/', 1)) AS n_owners, regexp_matches(v, '[0-9]') AND
        regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(v, '{PLACEHOLDER}') AND n_owners <= {MAX_OWNERS} AS live
        FROM base JOIN d USING (doc_id) GROUP BY v),
more AS (SELECT x.* FROM bare x JOIN own ON own.v = x.v AND own.live WHERE regexp_matches(x.v, '[0-9]') AND NOT EXISTS (
         SELECT 1 FROM base s WHERE s.doc_id = x.doc_id AND s.b < x.b + x.n AND x.b < s.b + s.n)),
every AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM more),
text AS (SELECT doc_id, is_base, b, kind, ['assign', 'access', 'hex', 'reuse'][kind] || ':' || b || ':' || (b + n) AS x
         FROM every),
s AS (SELECT doc_id, string_agg(x, ',' ORDER BY b, kind) AS spans,
      string_agg(x, ',' ORDER BY b, kind) FILTER (WHERE is_base) AS base,
      count(*) FILTER (WHERE kind = 1) AS n_assign, count(*) FILTER (WHERE kind = 2) AS n_access,
      count(*) FILTER (WHERE kind = 3) AS n_hex FROM text GROUP BY doc_id),
o AS (SELECT doc_id, count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE n_owners > {MAX_OWNERS}) AS n_example
      FROM base JOIN own USING (v) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN o USING (doc_id)
"""
