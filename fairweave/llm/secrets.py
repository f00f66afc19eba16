"""Secret scans with multipart credential linking.

Plain patterns give the base spans: assigned secrets, access identifiers and long
hexadecimal strings.  Weaker parts (account identifiers, key-like assignments, endpoints)
are common in clean text and are reported only when complementary parts stand within one
scope: an interval join over each text's parts, done by the furthest end before and the
next start after each part, finds the roles within reach of it.  A weak part is reported if it and the parts
within reach make up at least two roles, one of them a secret.

DataFrame functions only.  Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairweave.llm._shared import sized, table, written

#: Kinds in order: name, pattern, least length (of group 2 for assign), role, base or weak, and
#: lower-case strings of which a text must hold one to be searched.
KINDS = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, "secret", True, ["password", "passwd", "secret", "token", "apikey", "api_key"]),
    ("access", r"AKIA[A-Z0-9]+", 18, "identifier", True, ["akia"]),
    ("hex", r"[0-9a-f]{16,}", 16, "secret", True, []),
    ("identifier", r"(?i)(username|user_?id|login|account|client_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@_.-]+)", 3, "identifier", False, ["user", "login", "account", "client"]),
    ("key", r"(?i)(passphrase|pwd|private_?key|auth_?key|credential)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, "secret", False, ["passphrase", "pwd", "key", "credential"]),
    ("endpoint", r"(?i)(https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|ftp)://([A-Za-z0-9@:%/_.?=&-]+)", 4, "endpoint", False, ["://"]),
]
_PIECES = "array<struct<ord:int,i:int,piece:int,match:int,value:int>>"


def _found(text: Column, order: int, kind: tuple) -> Column:
    """Lengths of the pieces between matches of one kind, of the matches and of their values."""
    name, pattern, _, _, _, needs = kind
    low = F.lower(text)
    worth = F.lit(False)
    if name == "hex":
        worth = text.rlike(pattern)
    for need in needs:
        worth = worth | low.contains(need)
    both = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    value = lambda m: F.length(F.regexp_extract(m, pattern, 2) if "(" in pattern.replace("(?i)", "") else m)
    one = lambda x, i: F.struct(F.lit(order).alias("ord"), i.alias("i"), F.length(x["piece"]).alias("piece"), F.length(x["match"]).alias("match"), value(x["match"]).alias("value"))
    return F.when(worth, F.transform(both, one)).otherwise(F.array().cast(_PIECES))


def parts(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, ord, name, role, base, start, stop) of all matches that are long enough.

    One scan of the texts.  Repeated rows of a text give its matches once.
    """
    rows = F.concat(*[_found(F.col("text"), order, kind) for order, kind in enumerate(KINDS)])
    out = docs.select("doc_id", "digest", F.explode(rows).alias("m")).select("doc_id", "digest", "m.*")
    upto = Window.partitionBy("doc_id", "digest", "ord").orderBy("i")
    out = out.repartition("doc_id", "digest").dropDuplicates(["doc_id", "digest", "ord", "i"])
    start = F.sum("piece").over(upto.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(F.sum("match").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of = lambda k: F.element_at(F.array(*[F.lit(kind[k]) for kind in KINDS]), F.col("ord") + 1)
    least = of(2)
    out = out.withColumn("start", start).where(F.col("match").isNotNull() & (F.col("value") >= least))
    return out.select("doc_id", "digest", "ord", of(0).alias("name"), of(3).alias("role"), of(4).alias("base"), F.col("start").cast("long").alias("start"), (F.col("start") + F.col("match")).cast("long").alias("stop"))


def linked_spans(docs: DataFrame, scope: int = 200) -> DataFrame:
    """Base parts, and weak parts with complementary parts at most ``scope`` code points away.

    The distance is the gap between the end of one part and the start of the next.
    """
    found = parts(docs)
    order = Window.partitionBy("doc_id", "digest").orderBy("start", "ord")
    upto, onward = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)

    def reached(role):
        left = F.max(F.when(F.col("role") == role, F.col("stop"))).over(upto) >= F.col("start") - scope
        right = F.min(F.when(F.col("role") == role, F.col("start"))).over(onward) <= F.col("stop") + scope
        return (F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))).cast("int")

    roles = [reached(r) for r in ("secret", "identifier", "endpoint")]
    before = F.max(F.when(F.col("base"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    found = found.withColumns({"secret": roles[0], "kinds": roles[0] + roles[1] + roles[2], "before": before, "after": after})
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("stop")) >= F.col("stop"))
    linked = (F.col("secret") == 1) & (F.col("kinds") >= 2) & free
    return found.where(F.col("base") | linked).select("doc_id", "digest", "ord", "name", "base", "start", "stop")


def _listed(spans: DataFrame) -> DataFrame:
    """(doc_id, digest, spans): the spans of a text in order."""
    span = F.struct("start", "ord", "stop", "name", "base")
    return spans.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))


def find_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """Find secrets in every text.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.

    Returns one row per input row: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans as
    kind:start:end by start, then kind, joined by commas), spans (all spans, joined likewise) and n_linked
    (weak parts reported).  A null or empty text has none.  Repeated rows get the same result.  An empty
    table gives no rows.
    """
    source = _source(docs)
    listed = written(_listed(linked_spans(source.where("text is not null"), scope)), "spans").withColumnsRenamed({"doc_id": "d", "digest": "g"})
    listed = sized(listed)
    out = source.drop("text").join(listed, source["doc_id"].eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,ord:int,stop:bigint,name:string,base:boolean>>"))
    label = lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["stop"].cast("string"))
    count = lambda name: F.size(F.filter(spans, lambda s: s["name"] == name)).cast("long").alias(f"n_{name}")
    base = F.array_join(F.transform(F.filter(spans, lambda s: s["base"]), label), ",")
    return out.select(
        "doc_id",
        *[count(k[0]) for k in KINDS if k[4]],
        F.sha2(base, 256).alias("base_sha256"),
        F.array_join(F.transform(spans, label), ",").alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["base"])).cast("long").alias("n_linked"),
    )


def redact_secrets(docs: DataFrame, scope: int = 200, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of ``find_secrets`` replaced by ``mark``; overlapping spans once.

    All columns and rows are kept, whatever the other columns are called; a null text stays null.
    """
    source = _source(docs)
    listed = sized(written(_listed(linked_spans(source.where("text is not null"), scope)), "spans").withColumnsRenamed({"doc_id": "d", "digest": "g"}))
    # columns by place while they meet the spans, so that no name can clash
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*at.values())
    text, doc_id = F.col(at["text"]), F.col(at["doc_id"])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        cut = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        whole = F.concat(acc["out"], cut, F.when(s["start"] >= acc["at"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), whole.alias("out"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    joined = rows.join(listed, doc_id.cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(text) == F.col("g")), "left")
    clean = F.when(F.col("spans").isNotNull() & text.isNotNull(), F.aggregate("spans", start, step, finish)).otherwise(text)
    return joined.select(*[(clean if c == "text" else F.col(at[c])).alias(c) for c in docs.columns])


def op2_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``."""
    return find_secrets(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same for DuckDB."""
    quoted = lambda p: p.replace("'", "''")
    rows = []
    for order, (name, pattern, least, role, base, _) in enumerate(KINDS):
        value = f"length(regexp_extract(ms[i], '{quoted(pattern)}', 2))" if "(" in pattern.replace("(?i)", "") else "length(ms[i])"
        rows.append(
            f"""SELECT doc_id, {order} AS ord, '{name}' AS name, '{role}' AS role, {str(base).upper()} AS base, s AS start, s + length(ms[i]) AS stop
  FROM (SELECT doc_id, ms, i, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
    FROM (SELECT doc_id, ps, ms, unnest(range(1, len(ms) + 1)) AS i
      FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{quoted(pattern)}') AS ps, regexp_extract_all(coalesce(text, ''), '{quoted(pattern)}') AS ms FROM documents)))
  WHERE {value} >= {least}"""
        )
    union = "\nUNION ALL\n".join(rows)
    return f"""
WITH p AS ({union}),
r AS (SELECT a.doc_id, a.start, a.ord, max(CASE WHEN b.role = 'secret' THEN 1 ELSE 0 END) AS sec, max(CASE WHEN b.role = 'identifier' THEN 1 ELSE 0 END) AS idn, max(CASE WHEN b.role = 'endpoint' THEN 1 ELSE 0 END) AS ep
  FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.start <= a.stop + 200 AND b.stop >= a.start - 200 GROUP BY a.doc_id, a.start, a.ord),
f AS (SELECT p.*, sec, idn, ep,
  max(CASE WHEN base THEN stop END) OVER (PARTITION BY p.doc_id ORDER BY p.start, p.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b4,
  min(CASE WHEN base THEN p.start END) OVER (PARTITION BY p.doc_id ORDER BY p.start, p.ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS aft
  FROM p JOIN r ON p.doc_id = r.doc_id AND p.start = r.start AND p.ord = r.ord),
k AS (SELECT *, name || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR) AS label FROM f
  WHERE base OR (sec = 1 AND sec + idn + ep >= 2 AND coalesce(b4, 0) <= start AND coalesce(aft, stop) >= stop)),
g AS (SELECT doc_id, count(*) FILTER (WHERE name = 'assign') AS n_assign, count(*) FILTER (WHERE name = 'access') AS n_access, count(*) FILTER (WHERE name = 'hex') AS n_hex,
  string_agg(label, ',' ORDER BY start, ord) FILTER (WHERE base) AS b, string_agg(label, ',' ORDER BY start, ord) AS s, count(*) FILTER (WHERE NOT base) AS n_linked FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


OP2_SQL = _sql()
