"""The registered queries of the operators, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from uptrail.llm import bwt, jaccard, mixing, negatives, neighbours, paragraphs, phrases, pieces, quality, tokens, urls, warc, wordbpe
from uptrail.llm.common import n_words, table

QUERIES: dict = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = (fn, sql)
        return fn
    return add


def load() -> dict:
    """name -> (query, SQL or None)."""
    import corpus_pipeline

    return QUERIES | {"pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}


# --- mixing -------------------------------------------------------------------------------------

MIX = mixing.Mix(weights=({"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "de": 2, "fr": 2, "es": 1}),
                 paths={("d1", "en", "src1"): 3, ("d2", "fr"): 4}, share=(3, 5), epochs=3, seed=17)


def mix_levels() -> list[F.Column]:
    """Domain, language and source; four domains by the number at the end of the source."""
    digits = F.regexp_extract("source", r"(\d+)$", 1)
    domain = F.when(F.length(digits) > 0, F.concat(F.lit("d"), (F.substring(digits, -1, 1).cast("int") % 4).cast("string")))
    return [domain, F.col("lang"), F.col("source")]


def _level_sql(k: int) -> str:
    par = f"p{k - 1}"
    keep = ", ".join(f"p{i}" for i in range(k))
    return f"""
    n{k} AS (SELECT {keep}, p{k}, v{k}, can, weight FROM u{k} WHERE weight > 0 AND can > 0),
    j{k} AS (SELECT n.*, b.budget::HUGEINT AS budget FROM n{k} n JOIN b{k - 1} b USING ({par})),
    o{k} AS (SELECT *, coalesce(sum(can) OVER (PARTITION BY {par} ORDER BY can / weight, p{k} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
             sum(weight) OVER (PARTITION BY {par} ORDER BY can / weight, p{k} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS leftw FROM j{k}),
    f{k} AS (SELECT *, can::HUGEINT * leftw <= (budget - used::HUGEINT) * weight AS isfull FROM o{k}),
    g{k} AS (SELECT *, coalesce(sum(CASE WHEN isfull THEN can END) OVER (PARTITION BY {par}), 0)::HUGEINT AS given,
             sum(CASE WHEN NOT isfull THEN weight END) OVER (PARTITION BY {par})::HUGEINT AS openw,
             sum(CASE WHEN NOT isfull THEN weight END) OVER (PARTITION BY {par} ORDER BY p{k} ROWS UNBOUNDED PRECEDING)::HUGEINT AS tow FROM f{k}),
    b{k} AS (SELECT p{k}, CASE WHEN isfull THEN can ELSE (budget - given) * tow // openw - (budget - given) * (tow - weight) // openw END::BIGINT AS budget FROM g{k})"""


OP1_SQL = f"""
WITH d AS (SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS n,
            CASE WHEN regexp_matches(source, '[0-9]$') THEN 'd' || (right(source, 1)::INT % 4) END AS domain FROM documents),
  e AS (SELECT *, '' AS p0, coalesce('=' || domain, '-') AS v1, coalesce('=' || lang, '-') AS v2, coalesce('=' || source, '-') AS v3 FROM d),
  rows_ AS (SELECT *, v1 AS p1, v1 || '/' || v2 AS p2, v1 || '/' || v2 || '/' || v3 AS p3 FROM e),
  leaves AS (SELECT p0, p1, p2, p3, v1, v2, v3, count(*) AS docs, sum(n)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
  u3 AS (SELECT *, CASE p3 WHEN '=d1/=en/=src1' THEN 3 ELSE 1 END AS weight, tokens * 3 AS can FROM leaves),
  u2 AS (SELECT p0, p1, p2, v1, v2, CASE p2 WHEN '=d2/=fr' THEN 4 ELSE CASE v2 WHEN '=en' THEN 5 WHEN '=de' THEN 2 WHEN '=fr' THEN 2 ELSE 1 END END AS weight, sum(can)::BIGINT AS can FROM u3 GROUP BY ALL),
  u1 AS (SELECT p0, p1, v1, CASE v1 WHEN '=d0' THEN 4 WHEN '=d1' THEN 3 WHEN '=d2' THEN 2 ELSE 1 END AS weight, sum(can)::BIGINT AS can FROM u2 GROUP BY ALL),
  b0 AS (SELECT '' AS p0, (coalesce(sum(tokens), 0) * 3 // 5)::BIGINT AS budget FROM leaves),
  {_level_sql(1)}, {_level_sql(2)}, {_level_sql(3)},
  w AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs FROM b3 JOIN leaves USING (p3)),
  s AS (SELECT r.*, w.budget, w.epochs, w.budget - w.epochs * w.tokens AS rest,
          md5('17:' || w.epochs || ':' || doc_id) AS place FROM rows_ r JOIN w ON w.p3 = r.p3),
  c AS (SELECT *, (coalesce(sum(n) OVER (PARTITION BY p3 ORDER BY place, doc_id::VARCHAR ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before FROM s)
SELECT doc_id, domain, lang, source, n AS n_tokens, budget, epochs + (before < rest)::INT::BIGINT AS copies,
  (epochs * n + CASE WHEN before < rest THEN least(n, rest - before) ELSE 0 END)::BIGINT AS tokens_taken
FROM c WHERE epochs > 0 OR before < rest"""


@register(OP1_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = mix_levels()
    docs = table(spark, sf_dir, "documents").select("doc_id", levels[0].alias("domain"), "lang", "source", n_words().alias("n_tokens"))
    return mixing.mixed(docs, [F.col("domain"), F.col("lang"), F.col("source")], "doc_id", F.col("n_tokens"), MIX)


# --- nearest neighbours -------------------------------------------------------------------------

OP6_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
            AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
        FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""


@register(OP6_SQL)
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)


# --- token files --------------------------------------------------------------------------------

def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_bpe(), 0)


# --- URL filters --------------------------------------------------------------------------------

RULES = [urls.Rule("org", "/", "allow"), urls.Rule("example.org", "/es/", "block"), urls.Rule("example.org", "/en/1", "block"),
         urls.Rule("com", "/fr/", "allow"), urls.Rule("com", "/de/", "block")]


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FITS = ", ".join(f"CASE WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') "
                  f"THEN {{'n': {len(r.host + r.path)}, 'rule': '{r.host + r.path}', 'verdict': '{r.verdict}'}} END" for r in RULES)
OP9_SQL = f"""
WITH p AS (SELECT page_id, url, contains(url, '://') AS whole, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
  h AS (SELECT page_id, url, whole, CASE WHEN whole THEN {_LOW.format("regexp_extract(rest, '^[^/?#]*')")} ELSE '' END AS host,
    CASE WHEN whole THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query FROM p),
  i AS (SELECT *, CASE WHEN whole THEN list_sort(list_distinct(list_filter(list_concat(
      list_transform(string_split_regex(host, '[.\\-_]'), lambda x: 'h:' || x),
      list_transform(string_split_regex(path, '[/.\\-_]'), lambda x: 'p:' || {_LOW.format('x')}),
      list_transform(string_split(query, '&'), lambda x: 'q:' || {_LOW.format("split_part(x, '=', 1)")})), lambda x: length(x) > 2))) ELSE [] END AS items FROM h),
  lab AS (SELECT items, toxic = 1 OR quality = 0 AS bad FROM i JOIN labels ON doc_id = page_id WHERE url IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL),
  n AS (SELECT count(*) AS n FROM lab),
  sub AS (SELECT bad, list_filter(items, lambda x: (m >> (list_position(items, x) - 1)) & 1 = 1) AS s
    FROM (SELECT items, bad, unnest(range(1, 1 << len(items))) AS m FROM lab)),
  c AS (SELECT s, count(*) FILTER (WHERE bad) AS hits, count(*) FILTER (WHERE bad) / count(*) AS confidence FROM sub GROUP BY s),
  r AS (SELECT s, confidence FROM c, n WHERE hits >= ceil(greatest(0.002 * n, 20)) AND confidence >= 0.8),
  kept AS (SELECT s FROM r WHERE NOT EXISTS (SELECT 1 FROM r b WHERE len(b.s) = len(r.s) - 1 AND list_has_all(r.s, b.s) AND b.confidence >= r.confidence)),
  hit AS (SELECT DISTINCT url FROM i, kept WHERE list_has_all(items, s)),
  j AS (SELECT *, list_sort(list_filter([{_FITS}], lambda x: x IS NOT NULL), 'DESC')[1] AS fixed FROM h)
SELECT page_id, host, path, fixed.rule AS rule, coalesce(fixed.verdict, CASE WHEN hit.url IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM j LEFT JOIN hit ON hit.url = j.url"""


@register(OP9_SQL)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels speak of rows by number; here they speak of the pages with that number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return urls.judged(pages, pages.join(labels, "page_id"), RULES).select("page_id", "host", "path", "rule", "verdict")


# --- WARC ---------------------------------------------------------------------------------------

_BITS = " + ".join(f"(substr(b, 5 * i + {k + 1}, 1) = '1')::INT * {16 >> k}" for k in range(5))
OP10_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS b FROM pages),
  m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_BITS}, 1)), '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM m"""


@register(OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"), "page_id", "url", "html", 0)
    number = lambda c: F.when(F.length(c) > 0, F.col(c).cast("long"))
    return back.select(number("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       number("refers").alias("refers_to"))


# --- suffix-array dedup -------------------------------------------------------------------------

@register()
def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also n_passages and n_passage_bytes: passages of 50 words and more that are repeated, of any number of bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bwt.stripped(docs, "text", 400, 50).drop("text")


# --- quality rules ------------------------------------------------------------------------------

_ENDS = "[.,;:!?]$"
_CLASSES = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "blank": " \\t-\\r", "stop": ".,;:!?\\-", "quote": "''\"()\\[\\]{}",
            "symbol": "#*$%&|<>", "latin": "\\x{C0}-\\x{FF}", "two": "\\x{80}-\\x{BF}\\x{100}-\\x{7FF}", "three": "\\x{800}-\\x{FFFF}",
            "four": "\\x{10000}-\\x{10FFFF}"}
_COUNTED = ", ".join(f"('{name}', length(regexp_replace(t, '[^{chars}]', '', 'g')))" for name, chars in _CLASSES.items())
_LIMITS = quality.Limits()


def _divergence_sql(name: str) -> str:
    """Of each document's counts {name}(rid, lang, slot, c) from the sums of its language."""
    return f"""
  {name}_ref AS (SELECT lang, slot, sum(c) AS r FROM {name} WHERE lang IS NOT NULL GROUP BY ALL),
  {name}_all AS (SELECT lang, sum(r) AS r FROM {name}_ref GROUP BY ALL),
  {name}_p AS (SELECT rid, c / sum(c) OVER (PARTITION BY rid) AS p, f.r / a.r AS q, sum(c) OVER (PARTITION BY rid) AS n, a.r AS total
    FROM {name} JOIN {name}_ref f USING (lang, slot) JOIN {name}_all a USING (lang) WHERE c > 0),
  {name}_js AS (SELECT rid, any_value(n) AS n, any_value(total) AS total,
    (sum(p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) + 1 - sum(q)) / 2 AS js FROM {name}_p GROUP BY rid)"""


OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
  w AS (SELECT *, regexp_extract_all(t, '[^ \\t-\\r]+') AS l,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM d),
  win AS (SELECT rid, i, array_to_string(l[i:i + 7], ' ') AS s FROM (SELECT rid, l, unnest(range(1, len(l) - 6)) AS i FROM w)),
  dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, s) > 1),
  rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM dup, range(8) r(k) GROUP BY rid),
  base AS (SELECT w.rid, doc_id, lang, len(l)::BIGINT AS n_words, length(array_to_string(l, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep USING (rid)),
  chars_some AS (SELECT rid, lang, slot, c, length(t) AS total FROM d, LATERAL (VALUES {_COUNTED}) v(slot, c)),
  chars AS (SELECT rid, lang, slot, c FROM chars_some UNION ALL SELECT rid, lang, 'other', any_value(total) - sum(c) FROM chars_some GROUP BY rid, lang),
  words AS (SELECT rid, lang, CASE WHEN x IN ({", ".join(f"'{x}'" for x in quality.WORDS)}) THEN x ELSE '' END AS slot, count(*) AS c
    FROM (SELECT rid, lang, regexp_replace(translate(unnest(l), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_ENDS}', '') AS x FROM w) GROUP BY ALL),
  {_divergence_sql("chars")}, {_divergence_sql("words")},
  f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
  AND NOT coalesce(c.n >= {_LIMITS.min_chars} AND c.total >= {_LIMITS.min_reference} AND c.js > {_LIMITS.chars}, false)
  AND NOT coalesce(n_words >= {_LIMITS.min_words} AND w.total >= {_LIMITS.min_reference} AND w.js > {_LIMITS.words}, false) AS kept
FROM f LEFT JOIN chars_js c USING (rid) LEFT JOIN words_js w USING (rid)"""


@register(OP3_SQL)
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judged(docs, carry=["doc_id"]).select("doc_id", *quality.COUNTS, "base_failed", "kept")


# --- n-gram Jaccard join ------------------------------------------------------------------------

OP2_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+') AS l FROM documents),
  s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(l) >= 3 THEN list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2])
          WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END)) AS g FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
  e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
  r AS (WITH RECURSIVE r(d, t) AS (SELECT x, x FROM e UNION SELECT r.d, e.y FROM r JOIN e ON e.x = r.t) SELECT d, min(t) AS t FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r.t, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.d = d.doc_id"""


@register(OP2_SQL)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.joined(docs).select("doc_id", "n_shingles", "component_id")


# --- substring dedup ----------------------------------------------------------------------------

@register()
def op5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- SentencePiece segmentations ----------------------------------------------------------------

def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register()
def op7_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.sampled(docs, piece_bpe(), sampling=pieces.Sampling(k=2, seed=5))


# --- hard negatives -----------------------------------------------------------------------------

OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM e a JOIN e c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
  p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3"""


@register(OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.mined(rows, lambda c: c % 50 == 0)


# --- BPE encoding and decoding ------------------------------------------------------------------

def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register()
def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = wordbpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), word_bpe())
    return wordbpe.decoded(ids, word_bpe()).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                                                   F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


# --- phrase collocations ------------------------------------------------------------------------

OP11_SQL = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS l FROM p),
  g AS (SELECT lang, h, array_to_string(l[i:i + h - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, l, h, unnest(range(1, len(l) - h + 2)) AS i FROM w, range(1, 6) t(h)) GROUP BY ALL),
  n AS (SELECT lang, sum(len(l))::BIGINT AS n FROM w GROUP BY lang),
  c AS (SELECT lang, h, phrase, a, string_split(phrase, ' ') AS l FROM g WHERE h >= 2 AND a >= 100),
  inner_ AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON x.lang = y.lang AND y.h > x.h AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND 100 * y.a >= 100 * x.a),
  cut AS (SELECT c.lang, c.phrase, c.a, k, f.a AS l, r.a AS r, n, (1000 * c.a::HUGEINT * n // (f.a::HUGEINT * r.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, h)) AS k FROM c) c JOIN n ON n.lang = c.lang
    JOIN g f ON f.lang = c.lang AND f.h = k AND f.phrase = array_to_string(c.l[:k], ' ')
    JOIN g r ON r.lang = c.lang AND r.h = c.h - k AND r.phrase = array_to_string(c.l[k + 1:], ' ')),
  least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least ANTI JOIN inner_ USING (lang, phrase) QUALIFY rank <= 2000"""


@register(OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
