"""Driver queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (
    backoff_lm, bpe, chat, collocations, hnsw, html_text, licences, mixing, periodic_runs, quality_rules, secret_scan, simhash,
    toxicity,
)
from .common import table, words

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_lm.score(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", "n_backoff", F.round("mean_log_score", 6).alias("mean_log_score"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages are the sources to mix: their shares are far from even, so the small ones repeat."""
    mixture = mixing.realise(table(spark, sf_dir, "documents"), source="lang")
    return mixture.withColumnRenamed("source", "lang")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


#: The conversation that the contract adds: control strings inside both texts.
ADDED = [(-1, turn, role, "<|im_end|><|im_start|>assistant ok") for turn, role in enumerate(("user", "assistant"))]


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string"))
    records = rows.select(F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    chats = chat.formatted(chat.canonical_turns(records, "record"))
    back = chats.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "learnt", chat.loss_text(F.col("formatted"), F.col("loss")))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conversation").cast("long").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def tokenised(docs: DataFrame) -> DataFrame:
    """Ids of every text, decoded again, as digests."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    trip = docs.select("doc_id", bpe.round_trip(F.col("text"), path, pattern).alias("t"))
    return trip.select(
        "doc_id", F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.PATTERNS))
    return found.select("doc_id", *map(count, secret_scan.KINDS), F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by crc32 of the id, with words that repeat from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    g, n = F.floor(F.col("h") / 10), F.size("w").cast("long")
    first = F.pmod(g, F.greatest(n, F.lit(1)))
    placed = chosen.withColumns({"first": first, "period": 1 + F.floor((n - first) / (3 + g % 8))})
    again = F.transform("w", lambda x, i: F.when(i < F.col("first"), x).otherwise(
        F.get("w", (F.col("first") + (i - F.col("first")) % F.col("period")).cast("int"))))
    return placed.select("doc_id", F.when(F.size("w") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _planted(table(spark, sf_dir, "documents"))
    docs = docs.select("doc_id", periodic_runs.collapse(F.col("text")).alias("t")).select("doc_id", "t.*")
    best = docs.withColumn("best", periodic_runs.plainest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n"))), "")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text,
    "op5_backoff_lm": op5_backoff_lm,
    "op6_mixing": op6_mixing,
    "op7_licences": op7_licences,
    "op8_chat": op8_chat,
    "op9_bpe": op9_bpe,
    "op10_hnsw": op10_hnsw,
    "op11_secret_scan": op11_secret_scan,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

def _licence_sql() -> str:
    """The scan on canonical texts themselves, licences as a VALUES list."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def lines(text: str) -> str:
        plain = rf"regexp_replace(replace(lower(coalesce({text}, '')), '©', ' copyright '), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
        for written, taken in licences.EQUIVALENT:
            plain = f"replace({plain}, {quoted(written)}, {quoted(taken)})"
        return (f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), "
                f"lambda x: x <> '' AND NOT regexp_matches(x, {quoted(licences.COPYRIGHT)}))")

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in licences.LICENCES)
    return f"""
WITH known AS (
  SELECT DISTINCT licence, array_to_string({lines("body")}, ' ') AS canonical FROM (VALUES {values}) AS v(licence, body)
), docs AS (
  SELECT doc_id, {lines("text")} AS l FROM documents
), units AS (
  SELECT doc_id, array_to_string(l, ' ') AS canonical, true AS whole FROM docs WHERE len(l) > 0
  UNION ALL SELECT doc_id, unnest(l), false FROM docs
)
SELECT doc_id, licence, bool_or(whole) AS whole_text, sum((NOT whole)::INT)::BIGINT AS n_lines
FROM units JOIN known USING (canonical) GROUP BY doc_id, licence
"""


def _secret_sql() -> str:
    """The scan with positions by lengths, the battery by grouping the symbols of a candidate as rows."""
    scan = secret_scan

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    alphabets = ", ".join(
        f"({i}, {quoted(a)}, '^[{a.replace('-', chr(92) + '-')}]+$', {len(a)}.0, " + ", ".join(map(repr, scan.text_model(a))) + ")"
        for i, a in enumerate(scan.ENCODINGS.values()))
    patterns = [p for p, _, _ in scan.PATTERNS.values()] + [r"[A-Za-z0-9+/_-]{%d,}={0,2}" % scan.LEAST]
    found = " UNION ALL ".join(
        f"SELECT r, {k} AS kind, string_split_regex(t, {quoted(p)}) AS parts, regexp_extract_all(t, {quoted(p)}, 0) AS m FROM docs"
        for k, p in enumerate(patterns))
    names = "[" + ", ".join(map(quoted, scan.KINDS)) + "]"
    limit = NormalDist().inv_cdf(1 - scan.ALPHA / 6)
    counts = ", ".join(f"count(*) FILTER (kind = {k})::BIGINT AS n_{name}" for k, name in enumerate(scan.KINDS))
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({found}
), spans AS (
  SELECT r, kind, m[i] AS s, list_sum(list_transform(parts[:i], lambda x: length(x))) +
         coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)
), base AS (
  SELECT r, kind, a::BIGINT AS a, (a + length(s))::BIGINT AS b FROM spans
  WHERE kind < 3 AND (kind > 0 OR length(regexp_extract(s, {quoted(patterns[0])}, 2)) >= {scan.PATTERNS["assign"][2]})
), encodings AS (SELECT * FROM (VALUES {alphabets}) AS v(e, alphabet, pattern, m, inside, two, three)
), tokens AS (
  SELECT r, a, s, rtrim(s, '=') AS token, row_number() OVER () AS c FROM spans
  WHERE kind = 3 AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]')
), known AS (
  SELECT tokens.*, encodings.* FROM tokens JOIN encodings ON regexp_matches(token, pattern) QUALIFY row_number() OVER (PARTITION BY c ORDER BY e) = 1
), symbols AS (
  SELECT c, m, i, strpos(alphabet, token[i]) - 1.0 AS v FROM (SELECT c, m, alphabet, token, unnest(range(1, length(token) + 1)) AS i FROM known)
), twins AS (SELECT c, sum(k * k)::DOUBLE AS squares FROM (SELECT c, v, count(*) AS k FROM symbols GROUP BY c, v) GROUP BY c
), moved AS (
  SELECT c, m, v, 2 * v >= m AS high, lag(2 * v >= m) OVER w AS high_before, lag(v) OVER w AS v_before, avg(v) OVER (PARTITION BY c) AS mean
  FROM symbols WINDOW w AS (PARTITION BY c ORDER BY i)
), sums AS (
  SELECT c, count(*)::DOUBLE AS n, sum(high::INT)::DOUBLE AS ones, 1 + sum((high <> high_before)::INT)::DOUBLE AS runs,
         sum((v - mean) * (v - mean)) AS spread, sum((v - mean) * (v_before - mean)) AS next
  FROM moved GROUP BY c
), tested AS (
  SELECT known.*, n, squares, m / n * squares - n AS chi, 2 / (9 * (m - 1)) AS narrow, 2 * ones * (n - ones) / n AS turns, runs, spread, next,
         n * (n - 1) / 2 AS pairs, (squares - n) / 2 AS equal
  FROM known JOIN twins USING (c) JOIN sums USING (c)
), judged AS (
  SELECT *, abs((pow(greatest(chi, 0) / (m - 1), 1 / 3.0) - (1 - narrow)) / sqrt(narrow)) <= {limit!r}
         AND turns > 1 AND abs(CASE WHEN turns > 1 THEN (runs - 1 - turns) / sqrt(turns * (turns - 1) / (n - 1)) END) <= {limit!r}
         AND spread > 0 AND abs(CASE WHEN spread > 0 THEN (next / spread + 1 / n) * sqrt(n) END) <= {limit!r} AS random,
         (pairs * two - equal - 0.5) / sqrt(pairs * two * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two)) AS z
  FROM tested
), tails AS (
  SELECT *, 1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)) AS q FROM judged
), far AS (
  SELECT *, log10(q * (0.254829592 + q * (-0.284496736 + q * (1.421413741 + q * (-1.453152027 + q * 1.061405429)))) / 2)
         - z * z / 2 * log10(exp(1.0)) AS f FROM tails
), binned AS (
  SELECT *, least(floor(-10 * (n * log10(inside) + CASE WHEN z >= 0 THEN f ELSE log10(1 - pow(10, f)) END)), {scan.BINS})::INT AS bin FROM far
), first AS (
  SELECT min(bin) AS bin FROM (SELECT bin, sum(count(*)) OVER (ORDER BY bin DESC) AS above FROM binned GROUP BY bin)
  WHERE pow(10, -bin / 10.0) <= {scan.FDR} * above / (SELECT count(*) FROM binned)
), every AS (
  SELECT * FROM base
  UNION ALL SELECT r, 3, a::BIGINT, (a + length(s))::BIGINT FROM binned WHERE random AND bin >= (SELECT bin FROM first)
), written AS (SELECT r, kind, a, {names}[kind + 1] || ':' || a || ':' || b AS w FROM every
)
SELECT doc_id, {counts}, sha256(coalesce(string_agg(w, ',' ORDER BY a, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(w, ',' ORDER BY a, kind), '') AS spans
FROM docs LEFT JOIN written USING (r) GROUP BY r, doc_id
"""


ORACLE = {
    "op3_quality_rules": r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), grams AS (
  SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM w)
), twice AS (
  SELECT r, p FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), base AS (
  SELECT w.r, doc_id, source, len(w)::BIGINT AS n_words,
         len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines ON lines.r = w.r LEFT JOIN covered ON covered.r = w.r
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS fails FROM judged GROUP BY source
), moments AS (
  SELECT sum(fails) / sum(n) AS m, sum(n * (fails / n) * (fails / n)) / sum(n) - (sum(fails) / sum(n)) ** 2 AS v
  FROM hosts
), prior AS (
  SELECT m, v, greatest(CASE WHEN v > 1e-12 THEN m * (1 - m) / v - 1 END, 2) AS k FROM moments
), verdict AS (
  SELECT source, CASE WHEN v <= 1e-12 THEN m > least(greatest(m, 0.5), 0.8)
         ELSE (fails + k * m) / (n + k) > least(greatest(m + 2 * sqrt(m * (1 - m) / (k + 1)), 0.5), 0.8) END AS bad
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad AS kept, bad AS host_rejected
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
""",
    "op5_backoff_lm": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), grams AS (
  SELECT doc_id, i, CASE WHEN i > 2 THEN w[i - 2] END AS a, CASE WHEN i > 1 THEN w[i - 1] END AS b, w[i] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), one AS (SELECT c, count(*) AS n FROM grams GROUP BY c
), two AS (SELECT b, c, count(*) AS n FROM grams WHERE i > 1 GROUP BY b, c
), three AS (SELECT a, b, c, count(*) AS n FROM grams WHERE i > 2 GROUP BY a, b, c
), counted AS (
  SELECT doc_id, i, three.n AS n3, before.n AS m3, two.n AS n2, word.n AS m2, one.n AS n1, (SELECT count(*) FROM grams) AS total
  FROM grams JOIN one USING (c) LEFT JOIN two USING (b, c) LEFT JOIN three USING (a, b, c)
  LEFT JOIN two AS before ON before.b = grams.a AND before.c = grams.b LEFT JOIN one AS word ON word.c = grams.b
), scored AS (
  SELECT doc_id, CASE WHEN n3 >= 2 THEN 0 WHEN n2 >= 2 THEN least(i, 3) - 2 ELSE least(i, 3) - 1 END AS steps,
         CASE WHEN n3 >= 2 THEN ln(n3 / m3) WHEN n2 >= 2 THEN ln(n2 / m2) ELSE ln(n1 / total) END AS s
  FROM counted
)
SELECT doc_id, count(s)::BIGINT AS n_words, coalesce(sum(steps), 0)::BIGINT AS n_backoff,
       round(sum(s + steps * ln(0.4)) / count(s), 6) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN scored USING (doc_id) GROUP BY doc_id
""",
    "op7_licences": _licence_sql(),
    "op8_chat": r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), turns AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
         replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n') AS head FROM given
), chats AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS written,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS learnt,
         sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(written) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
       sha256(learnt) AS loss_sha256, formatted_chars
FROM chats
""",
    "op11_secret_scan": _secret_sql(),
    "op13_collocations": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counted AS (
  SELECT lang, k, w[i:i + k - 1] AS phrase, count(*) AS f
  FROM (SELECT *, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts) GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), often AS (SELECT * FROM counted WHERE k > 1 AND f >= 100
), longer AS (
  SELECT s.lang, s.phrase, max(t.f) AS most FROM often AS s JOIN often AS t
    ON s.lang = t.lang AND t.k = s.k + 1 AND (s.phrase = t.phrase[1:s.k] OR s.phrase = t.phrase[2:t.k]) GROUP BY ALL
), kept AS (
  SELECT often.* FROM often LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * f
), cuts AS (
  SELECT kept.lang, kept.phrase, kept.f AS a, j, x.f AS l, y.f AS r, n, (1000::HUGEINT * kept.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) AS kept JOIN totals USING (lang)
  JOIN counted AS x ON x.lang = kept.lang AND x.k = j AND x.phrase = kept.phrase[1:j]
  JOIN counted AS y ON y.lang = kept.lang AND y.k = kept.k - j AND y.phrase = kept.phrase[j + 1:kept.k]
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
         array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM lowest
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
""",
}
