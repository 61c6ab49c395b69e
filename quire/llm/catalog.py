"""The queries of this subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, circulant, filter_audit, fingerprint, language, packing, repetition, sanitise, simhash, spelling, token_counts, url_filter, weak_labels
from .common import inputs, read, workers_find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), capacity=1024)


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), fold_space=True)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = _tokenizer("byte_bpe_50k.tiktoken")
    both = bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, offset_digest=True, with_bytes=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"),
                       "offsets_sha256")


@query
def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = inputs(read(spark, sf_dir, "documents")).select("doc_id", repetition.repetition(F.col("text")).alias("r"))
    return judged.select("doc_id", "r.n_words", "r.word_chars", "r.n_symbols", "r.n_dup_lines", "r.n_repeat_words",
                         "r.base_failed", "r.kept", "r.covered")


# Windows of five words that occur twice cover the same words as repeated substrings of five words or
# more, and a repeat is longer than 50 words when some window of 51 words occurs twice.
ORACLES["op3_repetition_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT doc_id, n, i,
      string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS five,
      md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 50 FOLLOWING)) AS more FROM p),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) > 1 AS again FROM g WHERE i + 4 <= n),
f AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat FROM again, range(5) r(j) WHERE again GROUP BY doc_id),
o AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM g WHERE i + 50 <= n GROUP BY doc_id, more HAVING count(*) > 1)),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM
      (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
a AS (SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_repeat, 0) AS covered,
      o.doc_id IS NOT NULL AS over_longest FROM w
      LEFT JOIN f USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN o USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND covered <= 0.2 * n_words AND NOT over_longest AS kept, covered FROM b
"""


@query
def op8_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scorer, _ = weak_labels.quality(docs)
    return docs.select("doc_id", scorer.alias("q")).select("doc_id", "q.score", "q.kept")


@query
def op2_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(read(spark, sf_dir, "documents"), everywhere=True)
    base = F.filter("spans", lambda x: x["kind"].isin(*sanitise.KINDS))
    kinds = F.transform("spans", lambda x: x["kind"])
    count = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in sanitise.KINDS]
    return found.select("doc_id", *count, F.sha2(sanitise.joined(base), 256).alias("base_sha256"),
                        sanitise.joined(F.col("spans")).alias("spans"))


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _sql_rules() -> str:
    """Rule and verdict of host and path, the longest first."""
    out = []
    for verdict, rule in sorted(URL_RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        out.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{verdict} {rule}'")
    return f"CASE {' '.join(out)} END"


def _sql_smooth(n: str, t: str, total: str) -> str:
    """Witten-Bell interpolation of the five orders, the coarsest innermost."""
    p = "(1 / 256.0::DOUBLE)"
    for k in range(1, 6):
        p = f"(CASE WHEN k{k}.{total} > 0 THEN (k{k}.{n} + k{k}.{t} * {p}) / (k{k}.{total} + k{k}.{t})::DOUBLE ELSE {p} END)"
    return p


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op4_url_filter"] = f"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host,
      regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path,
      {_LOWER.format("CASE WHEN contains(url, '://') THEN rest ELSE coalesce(url, '') END")} AS text FROM u),
j AS (SELECT *, {_sql_rules()} AS judged FROM h),
t0 AS (SELECT text, count(*) FILTER (judged LIKE 'allow%') AS allow, count(*) FILTER (judged LIKE 'block%') AS block FROM j GROUP BY text),
t AS (SELECT *, substr(md5(text), 1, 1) IN ('0', '1', '2') AS held FROM t0),
p AS (SELECT text, CASE WHEN held THEN 0 ELSE allow END AS a, CASE WHEN held THEN 0 ELSE block END AS r,
      unnest(list_transform(range(2, length(text) + 3), lambda i: substr(chr(2) || text || chr(3), greatest(1, i - 4), least(5, i)))) AS gram FROM t),
f AS (SELECT gram, sum(a) AS a, sum(r) AS r FROM p GROUP BY gram),
s AS (SELECT a, r, unnest(list_transform(range(1, length(gram) + 1), lambda k: right(gram, k))) AS sub FROM f),
n AS (SELECT sub, sum(a) AS a, sum(r) AS r, left(sub, length(sub) - 1) AS ctx FROM s GROUP BY sub),
c AS (SELECT ctx, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr FROM n GROUP BY ctx),
k AS (SELECT n.sub, n.a, n.r, c.* FROM n JOIN c USING (ctx)),
d AS (SELECT f.gram, ln({_sql_smooth('a', 'ta', 'na')}) - ln({_sql_smooth('r', 'tr', 'nr')}) AS d FROM f
      JOIN k k1 ON k1.sub = right(gram, 1) {' '.join(f"LEFT JOIN k k{i} ON length(gram) >= {i} AND k{i}.sub = right(gram, {i})" for i in range(2, 6))}),
z AS (SELECT text, sum(d::DECIMAL(24, 12))::DOUBLE / count(*) AS score FROM p JOIN d USING (gram) GROUP BY text),
b AS (SELECT floor(least(greatest(score, -10), 10) / 0.01::DOUBLE)::BIGINT AS bin, sum(allow) AS a, sum(block) AS r
      FROM t JOIN z USING (text) WHERE held AND allow + block > 0 GROUP BY 1),
e AS (SELECT bin + 1 AS edge, sum(a) OVER w / sum(a) OVER () + 1 - sum(r) OVER w / sum(r) OVER () AS error, row_number() OVER w AS i
      FROM b WINDOW w AS (ORDER BY bin)
      UNION ALL SELECT min(bin), 1.0, 0 FROM b),
m AS (SELECT min(i) AS lo, max(i) AS hi FROM e WHERE error <= (SELECT min(error) FROM e) + 1e-12),
x AS (SELECT max(edge) FILTER (i = lo) AS one, max(edge) FILTER (i = least(hi + 1, (SELECT max(i) FROM e))) - 1 AS two FROM e, m),
y AS (SELECT CASE WHEN (SELECT coalesce(sum(a), 0) * coalesce(sum(r), 0) FROM b) = 0 THEN 0.0::DOUBLE
             ELSE 0.01::DOUBLE * floor((one + greatest(one, two)) / 2) END AS threshold FROM x)
SELECT page_id, host, path, substr(judged, 7) AS rule,
       coalesce(left(judged, 5), CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict
FROM j JOIN z USING (text), y
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    net = language.train(docs)
    named = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
                        language.predict(F.col("text"), net).alias("p"))
    return named.select("doc_id", "held_out", "p.lang_pred", "p.score")


@query
def op1_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(read(spark, sf_dir, "documents"))


_SQL_TREE = r"""list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(regexp_extract_all(p, '[^.!?]{{1,120}}[.!?]* ?|[.!?]+ ?'), lambda l: md5(l))))"""
_SQL_ROOT = """md5(list_aggregate(list_transform({0}, lambda s: md5(list_aggregate(list_transform(s,
    lambda p: md5(coalesce(list_aggregate(p, 'string_agg', ''), ''))), 'string_agg', ''))), 'string_agg', ''))"""
_SQL_SHOWN = _SQL_ROOT + """ || ':' || list_aggregate(list_transform({0}, lambda s: list_aggregate(list_transform(s,
    lambda p: coalesce(list_aggregate(list_transform(p, lambda h: h[1:8]), 'string_agg', '.'), '')), 'string_agg', ',')), 'string_agg', ';')"""
_SQL_LEAVES = "list_transform(flatten(flatten({0})), lambda h: h[1:8])"
_SQL_LIKE = """CASE WHEN {a}_root = {b}_root THEN 1.0::DOUBLE WHEN len({a}_set) + len({b}_set) = 0 THEN 0.0::DOUBLE
    ELSE 2.0::DOUBLE * len(list_intersect({a}_set, {b}_set)) / (len({a}_set) + len({b}_set)) END"""

ORACLES["op1_merkle_fingerprints"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next,
             length(text) AS n FROM d WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT *, text[1:n - n // 3] || next[1:n // 3] AS edited FROM o),
t AS (SELECT *, {_SQL_TREE.format('text')} AS a, {_SQL_TREE.format('edited')} AS b, {_SQL_TREE.format('next')} AS c FROM e),
r AS (SELECT *, {_SQL_SHOWN.format('a')} AS fa, {_SQL_SHOWN.format('b')} AS fb, {_SQL_ROOT.format('a')} AS a_root,
      {_SQL_ROOT.format('b')} AS b_root, {_SQL_ROOT.format('c')} AS c_root, {_SQL_LEAVES.format('a')} AS a_all,
      {_SQL_LEAVES.format('b')} AS b_all, list_distinct({_SQL_LEAVES.format('a')}) AS a_set,
      list_distinct({_SQL_LEAVES.format('b')}) AS b_set, list_distinct({_SQL_LEAVES.format('c')}) AS c_set FROM t)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
       {_SQL_LIKE.format(a='a', b='b')} AS near_edited, {_SQL_LIKE.format(a='a', b='c')} AS near_next,
       coalesce(list_min(list_filter(range(1, greatest(len(a_all), len(b_all)) + 1), lambda i: a_all[i] IS DISTINCT FROM b_all[i])) - 1,
                len(a_all)) AS n_same_leaves
FROM r
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


_SQL_PARTS = " UNION ALL ".join(f"SELECT '{f}' AS f, {i} AS bit" for i, f in enumerate(filter_audit.FILTERS))
ORACLES["op13_filter_audit"] = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
        len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS ({_SQL_PARTS}),
o AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM o),
r AS (SELECT part, filter_order, bits, n, good, toxic, fails, list_position(list_transform(bits, lambda b: fails[b + 1]), true) AS gone FROM c, o),
a AS (SELECT part, filter_order, step, s.bits[step] AS bit,
      coalesce(sum(n) FILTER (gone IS NULL OR gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
      coalesce(sum(n) FILTER (gone < step AND fails[s.bits[step] + 1]), 0) AS redundant,
      coalesce(sum(n) FILTER (fails[s.bits[step] + 1] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
      coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
      FROM r JOIN s USING (filter_order) GROUP BY part, filter_order, step, s.bits[step])
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM a
"""


@query
def op12_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, percent=80)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


# Near words by leaving out one code point: equal with the same place left out, or equal to the shorter word.
_SQL_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE r AS (SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z' || chr(192) || '-' || chr(255) || ']{7,}'))")} AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS named FROM r GROUP BY doc_id, run),
t AS (SELECT {_SQL_CRC_TABLE} AS crcs),
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(octet_length(encode(named))), lambda i: ('0x' || substr(hex(encode(named)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM d, t),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
o AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT x.word AS a, y.word AS b FROM o x JOIN o y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
      UNION SELECT o.word, w.word FROM o JOIN w ON o.rest = w.word UNION SELECT w.word, o.word FROM o JOIN w ON o.rest = w.word),
b AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-m.n, b)) AS best, max(m.n) AS best_n FROM p JOIN w m ON m.word = p.b GROUP BY a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
      CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
c AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL
"""

ORACLES["op12_circulant_minhash"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 2, least(len(w), 1) + 1)), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
k AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT k.a, e.b FROM k JOIN e ON e.a = k.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(k.b) AS component_id, d.doc_id = min(k.b) AS kept
FROM d JOIN k ON k.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
