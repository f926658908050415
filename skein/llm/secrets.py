"""Secret scans: multipart credential linking.

A scan of every whole text finds parts of credentials: identifiers, secrets and
endpoints. Three kinds are certain by their form and always reported (`assign`,
`access`, `hex`). The others (`named`, `user`, `endpoint`, `opaque`) are weak:
Spark joins the parts of a text as intervals, within a scope and a distance, and
a weak part is reported only where complementary parts co-occur.

* Roles: `access` and `user` are identifiers; `assign`, `hex`, `named` and
  `opaque` are secrets; `endpoint` is an endpoint.
* Scope: the lines of a text between two empty lines. Two parts are near where
  they share a scope and at most `reach` code points lie between them.
* A pair is an identifier near a secret. It counts where one of the two is
  certain, or where an endpoint is near one of the two. Both members of a pair
  that counts are reported, and the endpoints near them.
* A weak part is no part at all where it overlaps a part of an earlier kind of
  KINDS. E-mail addresses alone are not identifiers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import materialize

#: Kinds in the order of the contract, base kinds first; the number is the order among spans of one start.
KINDS = ["assign", "access", "hex", "named", "user", "endpoint", "opaque"]
BASE = 3
IDENTIFIER, SECRET, ENDPOINT = 0, 1, 2
ROLES = [SECRET, IDENTIFIER, SECRET, SECRET, IDENTIFIER, ENDPOINT, SECRET]

_SET = r"""["']?\x20*[:=]\x20*["']?"""
#: Pattern, number of the group whose length counts, least length of it; the patterns are for texts with A-Z folded where FOLDED says so.
PATTERNS = {
    "assign": (rf"(password|passwd|secret|token|api_?key){_SET}([a-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
    "named": (rf"(pass|pwd|auth|bearer|credentials?|private_?key|signature){_SET}([a-z0-9+/_.=-]+)", 2, 4),
    "user": (rf"(user_?name|user|login|account|client_?id|key_?id|access_?key){_SET}([a-z0-9@+/_.=-]+)", 2, 3),
    "endpoint": (rf"(https?|ftps?|sftp|ssh|s3|postgresql|postgres|mysql|mongodb|redis|amqps?)://[^\x20\x09-\x0D\"'<>]+|(hostname|host|server|endpoint|base_?url){_SET}[a-z0-9:/_.-]+", 0, 4),
    "opaque": (r"[A-Za-z0-9+/_=-]+", 0, 16),
}
FOLDED = {"assign", "named", "user", "endpoint"}
#: Code points of a bin of the interval join.
WIDTH = 1024

_COMPILED = {k: re.compile(p.encode()) for k, (p, _, _) in PATTERNS.items()}
_RUN = bytes(120 if re.match(rb"[A-Za-z0-9+/_=-]", bytes([x])) else 32 for x in range(256))
_OPAQUE = re.compile(rb"(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])")
_SHORT_HEX = re.compile(rb"(?=.*[a-f])(?=.*[0-9])[0-9a-f]+\Z")
_EMPTY_LINE = re.compile(rb"(?m)^\n")


def _runs(raw: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least so many characters of the opaque class."""
    folded, need = raw.translate(_RUN), b"x" * least
    at = folded.find(need)
    while at >= 0:
        to = folded.find(b" ", at)
        to = len(raw) if to < 0 else to
        yield at, to
        at = folded.find(need, to)


def parts_of(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, scope) of every part of one text, by start and kind; places in code points."""
    raw = text.encode()
    found: list[tuple[int, int, int]] = []

    def matches(kind: str, data: bytes) -> Iterator[re.Match]:
        _, group, least = PATTERNS[kind]
        return (m for m in _COMPILED[kind].finditer(data) if m.end(group) - m.start(group) >= least)

    low = raw.lower()
    sets = b"=" in raw or b":" in raw
    for kind in ("assign", "named", "user"):
        found += [(m.start(), KINDS.index(kind), m.end()) for m in (matches(kind, low) if sets else ())]
    found += [(m.start(), KINDS.index("endpoint"), m.end()) for m in (matches("endpoint", low) if sets else ())]
    found += [(m.start(), KINDS.index("access"), m.end()) for m in (matches("access", raw) if b"AKIA" in raw else ())]
    for lo, hi in _runs(raw, PATTERNS["opaque"][2]):  # a run of hex digits that counts is part of such a run
        run = raw[lo:hi]
        found += [(lo + m.start(), KINDS.index("hex"), lo + m.end()) for m in matches("hex", run)]
        if _OPAQUE.match(run) or _SHORT_HEX.match(run):
            found.append((lo, KINDS.index("opaque"), hi))
    if not found:
        return []
    found.sort()
    if any(k >= BASE for _, k, _ in found):
        kept, open_ = [], []  # spans that may still overlap what follows; few at any place
        for at, (start, kind, end) in enumerate(found):
            open_ = [x for x in open_ if x[2] > start]
            over = [x for x in open_ if x[1] < kind]
            for later in found[at + 1 :]:
                if later[0] >= end:
                    break
                if later[1] < kind:
                    over.append(later)
            open_.append((start, kind, end))
            if kind < BASE or not over:
                kept.append((start, kind, end))
        found = kept
    lines = [m.start() for m in _EMPTY_LINE.finditer(raw)] if b"\n" in raw else []
    scopes = [bisect_left(lines, start) for start, _, _ in found]
    if len(raw) != len(text):
        place, at, n = {}, 0, 0
        for p in sorted({p for s, _, e in found for p in (s, e)}):
            n += len(raw[at:p].decode())
            place[p], at = n, p
        found = [(place[s], k, place[e]) for s, k, e in found]
    return [(s, k, e, scope) for (s, k, e), scope in zip(found, scopes, strict=True)]


_PARTS = "array<struct<start: long, kind: int, end: long, scope: long>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, parts), one for each row of docs: all parts of its whole text, weak ones before any linking."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("start", "kind", "end", "scope")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                parts = [[dict(zip(names, p, strict=True)) for p in parts_of(x.as_py() or "")] for x in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(parts, _ARROW)], ["doc_id", "parts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id long, parts {_PARTS}")


def _bins(parts: DataFrame, grown: int) -> DataFrame:
    """A row for each bin that a part's interval, grown at both ends, lies in; first is the least of them."""
    low = F.greatest(F.col("start") - grown, F.lit(0))
    parts = parts.withColumn("first", F.floor(low / WIDTH))
    return parts.withColumn("bin", F.explode(F.sequence("first", F.floor((F.col("end") + grown) / WIDTH))))


def links(parts: DataFrame, reach: int) -> DataFrame:
    """Parts of different roles near one another: (row, a, a_kind, a_role, b, b_kind, b_role), a_role below b_role.

    An interval join: identifiers and secrets grown by `reach` meet what
    overlaps them in the bins of their scope, each pair in the first bin that
    both have. Parts of a kind never overlap, so a part has a bounded number of
    partners within reach and the links grow with the parts.
    """
    a = _bins(parts.where(F.col("role") < ENDPOINT), reach).select("row", "scope", "bin", *[F.col(c).alias(f"a_{c}") for c in ("no", "kind", "role", "start", "end", "first")])
    b = _bins(parts.where(F.col("role") > IDENTIFIER), 0).select("row", "scope", "bin", *[F.col(c).alias(f"b_{c}") for c in ("no", "kind", "role", "start", "end", "first")])
    near = (F.col("b_start") - F.col("a_end") <= reach) & (F.col("a_start") - F.col("b_end") <= reach)
    both = a.join(b, ["row", "scope", "bin"]).where((F.col("a_role") < F.col("b_role")) & near & (F.col("bin") == F.greatest("a_first", "b_first")))
    return both.select("row", F.col("a_no").alias("a"), "a_kind", "a_role", F.col("b_no").alias("b"), "b_kind", "b_role")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 300) -> DataFrame:
    """Rows (doc_id, spans), one for each row of docs: spans of what is reported, array<struct<start, kind, end, scope>> by start and kind.

    kind is the place in KINDS; starts and ends are code points, end exclusive.
    Null and empty texts have no spans; repeated rows, rows of one id with
    different texts and null ids each give a row of their own; an empty table
    gives no rows. Other columns are not read. Spark links parts only of texts
    that hold a weak one; what a text's parts need is bounded by the text.
    """
    rows = materialize(scan(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "secrets")
    weak = rows.where(F.exists("parts", lambda p: p.kind >= BASE))
    part = weak.select("row", F.posexplode("parts").alias("no", "p")).select("row", "no", "p.start", "p.end", "p.scope", "p.kind")
    part = part.withColumn("role", F.element_at(F.array(*map(F.lit, ROLES)), F.col("kind") + 1))
    near = materialize(links(part, reach), "links")
    ends = near.where(F.col("b_role") == ENDPOINT).select("row", F.col("a").alias("no"), F.col("b").alias("end_no"))
    ended = ends.select("row", "no").distinct()
    pairs = near.where((F.col("a_role") == IDENTIFIER) & (F.col("b_role") == SECRET))
    certain = (F.col("a_kind") < BASE) | (F.col("b_kind") < BASE)
    by_end = pairs.where(~certain)
    counts = pairs.where(certain).unionByName(by_end.join(ended.withColumnRenamed("no", "a"), ["row", "a"], "left_semi").select(pairs.columns))
    counts = counts.unionByName(by_end.join(ended.withColumnRenamed("no", "b"), ["row", "b"], "left_semi").select(pairs.columns))
    members = counts.select("row", F.explode(F.array("a", "b")).alias("no")).distinct()
    endpoints = ends.join(members, ["row", "no"], "left_semi").select("row", F.col("end_no").alias("no"))
    told = members.unionByName(endpoints).groupBy("row").agg(F.collect_set("no").alias("told"))
    spans = F.filter("parts", lambda p, i: (p.kind < BASE) | F.array_contains(F.coalesce("told", F.array().cast("array<int>")), i))
    return rows.join(told, "row", "left").select("doc_id", spans.alias("spans"))


def as_text(spans, most: int = len(KINDS)):
    """kind:start:end of the spans of the first kinds, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    told = F.transform(F.filter(spans, lambda p: p.kind < most), lambda p: F.concat_ws(":", F.element_at(names, p.kind + 1), p.start, p.end))
    return F.array_join(told, ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda p: p.kind == KINDS.index(kind))).cast("long")


def sql(reach: int = 300) -> str:
    """DuckDB SQL with the rows of op11 over documents."""

    def plain(pattern: str, kind: str) -> str:
        pattern = re.sub(r"[a-z](?![^\[]*\])", lambda m: f"[{m[0].upper()}{m[0]}]", pattern.replace(r"\x20", " ").replace(r"\x09-\x0D", "\t-\r")) if kind in FOLDED else pattern
        return "'" + (pattern.replace("[a-z0-9", "[A-Za-z0-9") if kind in FOLDED else pattern).replace("'", "''") + "'"

    found = []
    for no, kind in enumerate(KINDS):
        _, group, least = PATTERNS[kind]
        pattern = plain(PATTERNS[kind][0], kind)
        more = "" if kind != "opaque" else "AND (regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]') OR regexp_full_match(m, '[0-9a-f]+') AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-f]'))"
        found.append(f"""
SELECT r, {no} AS kind, '{kind}' AS name, {ROLES[no]} AS role, e - length(m) AS s, e FROM (
  SELECT r, m, g, sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, unnest(x) AS m, unnest(regexp_extract_all(t, {pattern}, {group})) AS g, unnest(p[:len(x)]) AS p, generate_subscripts(x, 1) AS i
    FROM (SELECT r, t, regexp_extract_all(t, {pattern}) AS x, string_split_regex(t, {pattern}) AS p FROM d))) WHERE length(g) >= {least} {more}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({' UNION ALL '.join(found)}
), part AS (
  SELECT f.*, len(list_filter(string_split(left(t, CAST(s AS BIGINT)), chr(10))[1:-2], lambda x: x = '')) AS scope FROM found f JOIN d USING (r)
  WHERE kind < {BASE} OR NOT EXISTS (SELECT 1 FROM found o WHERE o.r = f.r AND o.kind < f.kind AND o.s < f.e AND f.s < o.e)
), near AS (
  SELECT a.r, a.kind AS ak, a.role AS ar, a.s AS a_s, b.kind AS bk, b.role AS br, b.s AS b_s FROM part a JOIN part b
  ON a.r = b.r AND a.scope = b.scope AND a.role < b.role AND b.s - a.e <= {reach} AND a.s - b.e <= {reach}
), ended AS (SELECT DISTINCT r, ak AS kind, a_s AS s FROM near WHERE br = {ENDPOINT}
), pairs AS (
  SELECT n.* FROM near n WHERE ar = {IDENTIFIER} AND br = {SECRET} AND (ak < {BASE} OR bk < {BASE}
    OR EXISTS (SELECT 1 FROM ended e WHERE e.r = n.r AND e.kind = ak AND e.s = a_s) OR EXISTS (SELECT 1 FROM ended e WHERE e.r = n.r AND e.kind = bk AND e.s = b_s))
), members AS (SELECT r, ak AS kind, a_s AS s FROM pairs UNION SELECT r, bk, b_s FROM pairs
), told AS (SELECT * FROM members UNION SELECT n.r, n.bk, n.b_s FROM near n JOIN members m ON n.r = m.r AND n.ak = m.kind AND n.a_s = m.s WHERE n.br = {ENDPOINT}
), spans AS (SELECT p.*, name || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS span FROM part p WHERE kind < {BASE} OR (r, kind, s) IN (SELECT r, kind, s FROM told)
), byrow AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS c, count(*) FILTER (WHERE kind = 2) AS h,
    string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < {BASE}) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(byrow.spans, '') AS spans
FROM d LEFT JOIN byrow USING (r)
"""
