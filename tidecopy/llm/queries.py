"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark, sf_dir, name):
    """A table; and Python workers find the package as the driver does."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def op1_mix_sources(spark, sf_dir):
    from tidecopy.llm.mixing import mix_sources
    return mix_sources(_docs(spark, sf_dir), weights=(1, 2, 3), share=1.0, cap=3)


def op2_substring_dedup(spark, sf_dir):
    from tidecopy.llm.substring_dedup import substring_dedup
    return substring_dedup(_docs(spark, sf_dir), 35)


def op3_token_output(spark, sf_dir):
    from tidecopy.llm.token_output import token_output
    return token_output(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontaminate(spark, sf_dir):
    from tidecopy.llm.decontaminate import leaks
    return leaks(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op5_jaccard_join(spark, sf_dir):
    from tidecopy.llm.jaccard_join import jaccard_join
    return jaccard_join(_docs(spark, sf_dir), k=4, percent=85)


def op6_chat_windows(spark, sf_dir):
    from tidecopy.llm.chat import chat_digests
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text "
                        "UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    return chat_digests(turns.unionByName(planted), budget=512, history_turns=2, history_tokens=128)


def op7_kd_shards(spark, sf_dir):
    from tidecopy.llm.sharding import kd_shards
    return kd_shards(_docs(spark, sf_dir), 16)


def op8_token_counts(spark, sf_dir):
    from tidecopy.llm.token_counts import token_counts
    return token_counts(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op9_suffix_dedup(spark, sf_dir):
    from tidecopy.llm.suffix_dedup import suffix_dedup
    return suffix_dedup(_docs(spark, sf_dir), 50)


def op10_quality_rules(spark, sf_dir):
    from tidecopy.llm.quality import quality_rules
    return quality_rules(_docs(spark, sf_dir))


def op11_secret_spans(spark, sf_dir):
    from tidecopy.llm.secrets import secret_spans, span_digests
    return span_digests(secret_spans(_docs(spark, sf_dir)))


def op12_ranked_search(spark, sf_dir):
    from tidecopy.llm.ranked_search import build_index, search
    return search(build_index(_docs(spark, sf_dir)), read_table(spark, sf_dir, "benchmark"), k=10)


def op13_periodic_runs(spark, sf_dir):
    from tidecopy.llm.periodic_runs import periodic_runs
    runs = periodic_runs(_with_cycles(_docs(spark, sf_dir)), min_length=12)
    # the longest run; of equally long ones the first, then that of the least period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    runs = runs.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    said = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.expr("(1000 * best.length) div (-best.col3)").alias("exponent_milli"),
        F.sha2(F.array_join(said, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _with_cycles(docs):
    """Of every tenth document (by crc32 of its id) the words from one on repeat in a cycle, as op13's
    contract says; other documents, and those without id or words, stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"), F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10").alias("g"))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    d = d.withColumn("n", F.size("w")).withColumn("a", F.expr("cast(g % n AS int)"))
    d = d.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
    cycled = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(cycled, " ")).otherwise(F.col("text")).alias("text"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_substring_dedup, op3_token_output, op4_decontaminate, op5_jaccard_join, op6_chat_windows, op7_kd_shards, op8_token_counts, op9_suffix_dedup,
                                 op10_quality_rules, op11_secret_spans, op12_ranked_search, op13_periodic_runs)}


def _secret_sql():
    """op11 in SQL: matches by kind with their places, then the interval join."""
    either = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    assign = ("(" + "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
              + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
    ident = ("(?:" + "|".join(map(either, ("access_?key_?id", "client_?id", "user_?name", "user", "login", "account")))
             + r""")["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9@._+-]{4,}""")
    patterns = (assign, "AKIA[A-Z0-9]+", "[0-9a-f]{16,}", ident, "[A-Za-z0-9+/_-]{20,}",
                r"""(?:https?|ftp|s3|gs|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"''<>]+""",
                r"\n[\x20\x09\x0D]*\n")
    found = " UNION ALL ".join(
        f"SELECT rid, {k} AS k, regexp_extract_all(text, '{p}') AS f, string_split_regex(text, '{p}') AS g, "
        + (f"list_transform(regexp_extract_all(text, '{p}', 2), lambda x: length(x))" if k == 0 else "NULL::BIGINT[]")
        + f" AS e FROM docs WHERE regexp_matches(text, '{p}')" for k, p in enumerate(patterns))
    return f"""
      WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
      found AS ({found}),
      each AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM found),
      placed AS (SELECT rid, k, f[i] AS m, length(f[i]) AS n, e[i] AS e, list_sum(list_transform(g[1:i], lambda x: length(x)))
                        + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS s FROM each),
      kinds AS (SELECT rid, s::BIGINT AS s, (s + n)::BIGINT AS t,
                  CASE WHEN k = 0 THEN CASE WHEN e >= 12 THEN 0 WHEN e >= 6 THEN 4 END
                       WHEN k = 1 THEN CASE WHEN n >= 18 THEN 1 WHEN n >= 12 THEN 3 END
                       WHEN k = 4 THEN CASE WHEN n <= 128 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]')
                                                 AND regexp_matches(m, '[A-Z]') THEN 4 END
                       ELSE k END AS k FROM placed),
      parts AS (SELECT *, (SELECT count(*) FROM kinds b WHERE b.rid = a.rid AND b.k = 6 AND b.s < a.s) AS scope
                FROM kinds a WHERE k < 6),
      met AS (SELECT a.rid, a.k, a.s, a.t, bool_or(b.k <= 2 AND b.s < a.t AND a.s < b.t) AS inside,
                bool_or(b.k IN (1, 3)) AS id, bool_or(b.k = 1) AS plain_id, bool_or(b.k IN (0, 2, 4)) AS secret,
                bool_or(b.k IN (0, 2)) AS plain_secret, bool_or(b.k = 5) AS endpoint
              FROM parts a JOIN parts b ON a.rid = b.rid AND a.scope = b.scope AND b.s <= a.t + 256 AND a.s <= b.t + 256
              WHERE a.k > 2 GROUP BY ALL),
      spans AS (SELECT rid, k, s, t FROM parts WHERE k <= 2 UNION ALL
                SELECT rid, k, s, t FROM met WHERE NOT inside AND CASE k WHEN 3 THEN plain_secret OR (secret AND endpoint)
                  WHEN 4 THEN plain_id OR (id AND endpoint) ELSE id AND secret END),
      named AS (SELECT *, (['assign', 'access', 'hex', 'ident', 'value', 'endpoint'])[k + 1] || ':' || s || ':' || t AS said FROM spans)
      SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
             count(*) FILTER (WHERE k = 2) AS n_hex,
             sha256(coalesce(string_agg(said, ',' ORDER BY s, k) FILTER (WHERE k <= 2), '')) AS base_sha256,
             coalesce(string_agg(said, ',' ORDER BY s, k, t), '') AS spans
      FROM docs LEFT JOIN named USING (rid) GROUP BY rid, doc_id"""


ORACLES: dict[str, str] = {
    "op6_chat_windows": r"""
      WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
      a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS idx,
                   len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens FROM rows),
      b AS (SELECT *, idx = 1 AND role = 'system' AS is_system FROM a),
      c AS (SELECT *, sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER w AS hi,
                   greatest(1, 512 - 128 - sum(CASE WHEN is_system THEN tokens ELSE 0 END) OVER w) AS room
            FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
      d AS (SELECT *, hi - CASE WHEN is_system THEN 0 ELSE tokens END AS lo FROM c),
      e AS (SELECT *, (lo // room) || '-' || ((hi - 1) // room) AS cell FROM d),
      f AS (SELECT *, NOT is_system AND (coalesce(lag(is_system) OVER w, TRUE) OR lag(cell) OVER w <> cell) AS opens
            FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
      g AS (SELECT *, greatest(0, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY idx) - 1) AS own FROM f),
      h AS (SELECT *, max(own) OVER (PARTITION BY conv_id) AS last_own,
                   CASE WHEN lead(opens, 1) OVER w AND lead(lo, 1) OVER w - lo <= 128 THEN 1 ELSE 0 END
                   + CASE WHEN lead(opens, 2) OVER w AND lead(lo, 2) OVER w - lo <= 128 THEN 1 ELSE 0 END AS again
            FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
      sized AS (SELECT *, (CASE WHEN is_system THEN last_own ELSE again END + 1)
                     * (20 + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '[', '\s'))
                           + length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '[', '\s'))) AS chars FROM h)
      SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
             coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
             sha256(coalesce(string_agg(text, '' ORDER BY idx) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
             sum(chars)::BIGINT AS formatted_chars
      FROM sized GROUP BY conv_id""",
    "op11_secret_spans": _secret_sql(),
    "op12_ranked_search": r"""
      WITH lowered AS (SELECT row_number() OVER () AS d, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
      asked AS (SELECT row_number() OVER () AS q, item_id,
             unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
      sizes AS (SELECT count(*) FILTER (WHERE len(terms) > 0)::BIGINT AS n, coalesce(sum(len(terms)), 0)::BIGINT AS l FROM lowered),
      postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM lowered)
                   WHERE term IN (SELECT term FROM asked) GROUP BY d, term),
      weights AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, sizes GROUP BY term),
      docs AS (SELECT d, doc_id, 100 - 90 + (90 * len(terms) * n) // l AS m FROM lowered, sizes WHERE len(terms) > 0),
      scored AS (SELECT q, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
                        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
                 FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN docs USING (d) GROUP BY q, d),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS r FROM scored WHERE score > 0)
      SELECT item_id, r::INT AS rank, doc_id, score FROM ranked WHERE r <= 10""",
}
