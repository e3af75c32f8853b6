"""One query for each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fileload.llm import align, chat, decontam, extract, hmm, lines, minhash, pieces, quality, substrings, toxicity, urls, whiten

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces of MODEL.
PIECES = 32_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (n, key)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM tokens t LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.line_dedup(docs).select("doc_id", "n_lines", "n_removed", F.sha2("deduped", 256).alias("deduped_sha256"))


OP3_SQL = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(l[i:i + 2], chr(10)) AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM split WHERE len(l) >= 3)),
worded AS (SELECT * FROM windows WHERE regexp_matches(key, '[^ \t\n\v\f\r]')),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS r FROM worded) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM later),
numbered AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM split),
kept AS (SELECT n.doc_id, string_agg(line, chr(10) ORDER BY n.i) AS t, count(*) AS n
         FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i WHERE g.i IS NULL GROUP BY n.doc_id)
SELECT s.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(l), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN l IS NOT NULL THEN sha256(coalesce(t, '')) END AS deduped_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, width=4)
    # Of rows under one id none is told apart here.
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces_digest(pieces.encode_decode(docs, MODEL)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.score_links(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_MODEL, MODEL, PIECES)


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract_text(pages).select("page_id", "url", "text", "n_chars")


def pieces_digest(coded: DataFrame) -> DataFrame:
    return coded.withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
            "decoded_sha256": F.sha2("decoded", 256),
        }
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT -7L AS conv_id, i AS turn, r AS role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(i, r)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    chats = chat.format_chats(rows, chat.text_parts(F.col("text")))
    turns = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 3 + length(role) + 1 + 4 + length(text) + length(text) - length(replace(text, chr(9243), ''))
         + 2 * len(regexp_extract_all(text, '</?s>|\[/?INST\]|<</?SYS>>|<(image|audio|document)>')) AS size FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("deduped", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM tokens WHERE len(w) >= 50)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(key)) AS lo FROM windows) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
numbered AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM tokens),
kept AS (SELECT n.doc_id, string_agg(word, ' ' ORDER BY n.i) AS t, count(*) AS n
         FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i WHERE g.i IS NULL GROUP BY n.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM tokens t LEFT JOIN kept k USING (doc_id)
"""


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = hmm.held_out("doc_id")
    scored = hmm.train(docs.where(~out)).score(docs)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality.apply_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op7_cells() -> str:
    values = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
        "repeats_per_word": "n_repeat_words / greatest(n_words, 1)",
        "word_length": "word_chars / greatest(n_words, 1)",
    }
    return " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{r}' AS rate, {c}::DOUBLE AS cutoff, {values[r]} > {c}::DOUBLE AS away FROM placed"
        for r, grid in quality.GRID.items()
        for c in grid
    )


OP7_SQL = rf"""
WITH tokens AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS n
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS key
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM tokens WHERE len(w) >= 3))),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM tokens)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
facts AS (
  SELECT k.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM tokens k LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
strata AS (
  SELECT lang FROM facts JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND lang IS NOT NULL
  GROUP BY lang ORDER BY count(*) DESC, lang LIMIT {quality.MAX_STRATA}),
placed AS (SELECT f.*, coalesce(s.lang, '{quality.OTHER}') AS stratum FROM facts f LEFT JOIN strata s USING (lang)),
cells AS ({_op7_cells()}),
tests AS (
  SELECT stratum, rate, cutoff, count(*) FILTER (quality > 0) AS n, count(*) FILTER (quality > 0 AND away) AS k,
         count(*) FILTER (quality <= 0 AND away) AS bad_away
  FROM cells JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY stratum, rate, cutoff),
safe AS (
  SELECT *, row_number() OVER (PARTITION BY stratum, rate ORDER BY bad_away DESC, cutoff DESC) AS r FROM (
    SELECT *, list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
           + j * ln({quality.RISK / len(quality.GRID)!r}::DOUBLE) + (n - j) * ln(1 - {quality.RISK / len(quality.GRID)!r}::DOUBLE)))) AS p
    FROM tests WHERE k < n * {quality.RISK / len(quality.GRID)!r}::DOUBLE AND bad_away > 0)
  WHERE p <= {quality.DELTA / (quality.MAX_STRATA + 1) / sum(map(len, quality.GRID.values()))!r}::DOUBLE),
refused AS (SELECT DISTINCT doc_id FROM cells JOIN safe USING (stratum, rate, cutoff) WHERE r = 1 AND away)
SELECT p.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND x.doc_id IS NULL AS kept
FROM placed p LEFT JOIN refused x USING (doc_id)
"""

#: The rules that op8 is dealt: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _op8_sql() -> str:
    order = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in order]
    rule = " ".join(f"WHEN {f} THEN '{h + p}'" for f, (_, h, p) in zip(fits, order))
    verdict = " ".join(f"WHEN {f} THEN '{a}'" for f, (a, _, _) in zip(fits, order))

    def strength(level: str) -> str:
        return f"""(SELECT CASE WHEN coalesce(sum(n), 0) <= count(*) THEN {urls.STRENGTH[0]} ELSE 1 / least(greatest(
            (sum((bad - n * m) * (bad - n * m) / (n * m * (1 - m))) - count(*)) / (sum(n) - count(*)),
            {1 / (urls.STRENGTH[1] + 1)!r}), {1 / (urls.STRENGTH[0] + 1)!r}) - 1 END FROM {level} WHERE n > 0)"""

    second = ", ".join(f"'{x}'" for x in urls.SECOND_LEVEL)
    return rf"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS said FROM named),
hosts AS (
  SELECT host, string_split(host, '.') AS l, count(said) AS n, count(*) FILTER (said = 'block') AS bad FROM ruled GROUP BY host),
hosted AS (
  SELECT host, n, bad, array_to_string(l[greatest(1, len(l) - CASE WHEN len(l) > 2 AND l[len(l) - 1] IN ({second})
         AND length(l[len(l)]) = 2 THEN 2 ELSE 1 END):], '.') AS domain FROM hosts),
domains AS (SELECT domain, CASE WHEN contains(domain, '.') THEN substr(domain, instr(domain, '.') + 1) ELSE domain END AS suffix,
                   sum(n) AS n, sum(bad) AS bad FROM hosted GROUP BY domain),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM domains) AS m FROM domains GROUP BY suffix),
s1 AS (SELECT suffix, (bad + s * m) / (n + s) AS m FROM s0, (SELECT {strength("s0")} AS s)),
d0 AS (SELECT domain, n, bad, m FROM domains JOIN s1 USING (suffix)),
d1 AS (SELECT domain, (bad + s * m) / (n + s) AS m FROM d0, (SELECT {strength("d0")} AS s)),
h0 AS (SELECT host, n, bad, m FROM hosted JOIN d1 USING (domain)),
h1 AS (SELECT host, bad + s * m AS a, n - bad + s * (1 - m) AS b FROM h0, (SELECT {strength("h0")} AS s)),
own AS (SELECT host, a / (a + b) - {urls.BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM h1)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN low > {urls.BLOCK_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN own USING (host)
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_chat_format": op2_chat_format,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_minhash": op5_minhash,
    "op6_hmm": op6_hmm,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_toxicity": op9_toxicity,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_extraction": op13_extraction,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op2_chat_format": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_url_filters": _op8_sql(),
}
