"""Registered queries of the subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import exact_dedup, importance, lexical_search, line_dedup, mixing, near_dup, packing, quality_model, quality_rules, secret_scan, sharding, tokens, warc
from lakeloom.sources.tables import Tables


def op4(spark, folder):
    t = Tables(spark, folder)
    return quality_rules.quality_rules(t["documents"], t["labels"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6(spark, folder):
    return exact_dedup.exact_dedup(Tables(spark, folder)["documents"])


def op10(spark, folder):
    return near_dup.near_dup(Tables(spark, folder)["documents"])


def op8(spark, folder):
    return tokens.token_counts(Tables(spark, folder)["documents"])


def op7(spark, folder):
    return mixing.mix(Tables(spark, folder)["documents"]).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op9(spark, folder):
    return packing.pack(Tables(spark, folder)["documents"])


def op3(spark, folder):
    return sharding.shard(Tables(spark, folder)["documents"])


def op5(spark, folder):
    return warc.round_trip(Tables(spark, folder)["pages"])


def op2(spark, folder):
    return secret_scan.secret_scan(Tables(spark, folder)["documents"])


def op1(spark, folder):
    """Grades from the labels: 0 toxic, 1 poor, 2 good."""
    t = Tables(spark, folder)
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    ratings = t["labels"].select("doc_id", grade.alias("grade"))
    return quality_model.scored(t["documents"], quality_model.fit(t["documents"], ratings, grades=3))


def op11(spark, folder):
    return line_dedup.line_dedup(Tables(spark, folder)["documents"]).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12(spark, folder):
    t = Tables(spark, folder)
    return lexical_search.search(t["benchmark"], t["documents"])


def op13(spark, folder):
    t = Tables(spark, folder)
    return importance.resample(t["documents"], t["benchmark"])


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality_model": op1,
    "op2_secret_scan": op2,
    "op3_sharding": op3,
    "op4_quality_rules": op4,
    "op5_warc": op5,
    "op6_exact_dedup": op6,
    "op7_mixing": op7,
    "op8_token_counts": op8,
    "op9_packing": op9,
    "op10_near_dup": op10,
    "op11_line_dedup": op11,
    "op12_lexical_search": op12,
    "op13_importance": op13,
}

# 1000 * a / b and the like give doubles in DuckDB as in Spark.
_RULES = ", ".join(f"({sql}) AS r_{name}" for name, sql in quality_rules.RULES.items())
_GRID = ", ".join(f"('{name}', {c})" for name in quality_rules.RULES for c in quality_rules.CUTOFFS[name])
_ALPHA = quality_rules.ALPHA
_VALUE = "CASE rule " + " ".join(f"WHEN '{name}' THEN r_{name}" for name in quality_rules.RULES) + " END"
_HIT = " OR ".join(
    f"coalesce(r_{name} >= (SELECT max(cutoff) FROM chosen b WHERE b.rule = '{name}' AND b.lang IS NOT DISTINCT FROM c.lang), false)"
    for name in quality_rules.RULES)
_SHA_PART = "CAST('0x' || substr(sha1(t), 5 * i + 1, 5) AS BIGINT)"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({_SHA_PART} >> {k}) & 31 AS BIGINT) + 1, 1)" for k in (15, 10, 5, 0))

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op4_quality_rules": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
        s AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM d),
        w AS (SELECT rid, unnest(words) AS x, generate_subscripts(words, 1) AS pos FROM s),
        g AS (SELECT rid, pos, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
        h AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, x, y, z) AS n FROM g WHERE z IS NOT NULL),
        repeats AS (SELECT rid, count(DISTINCT pos + o) AS n FROM h, (VALUES (0), (1), (2)) AS v(o) WHERE h.n > 1 GROUP BY 1),
        lines AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
                  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
        n AS (SELECT rid, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
                CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^{quality_rules.SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
                CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
              FROM d JOIN s USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeats USING (rid)),
        c AS (SELECT *, {_RULES}, n_words < {quality_rules.MIN_WORDS}
                OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM n),
        l AS (SELECT doc_id, min(quality) = 1 AS good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS picks
              FROM labels WHERE quality IS NOT NULL GROUP BY 1),
        held AS (SELECT c.*, good, picks FROM c JOIN l USING (doc_id) WHERE NOT base_failed),
        size AS (SELECT lang, count(*) FILTER (good AND picks) AS n_pick, count(*) FILTER (good AND NOT picks) AS n_good,
                   count(*) OVER () AS strata FROM held GROUP BY 1),
        test AS (SELECT lang, rule, cutoff, count(*) FILTER (good AND {_VALUE} >= cutoff) AS lost,
                   count(*) FILTER (NOT good AND {_VALUE} >= cutoff) AS found
                 FROM held, (VALUES {_GRID}) AS v(rule, cutoff) WHERE picks GROUP BY ALL),
        best AS (SELECT test.lang, rule, max(found - lost) AS gain, arg_max(cutoff, (found - lost) * 100000 + cutoff) AS cutoff
                 FROM test JOIN size ON size.lang IS NOT DISTINCT FROM test.lang
                 WHERE found > lost AND lost <= {quality_rules.PICK_SHARE!r} * n_pick GROUP BY 1, 2),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY gain DESC, rule) AS place FROM best),
        hit AS (SELECT held.rid, held.lang, min(place) AS first FROM held JOIN placed ON placed.lang IS NOT DISTINCT FROM held.lang
                WHERE good AND NOT picks AND {_VALUE} >= cutoff GROUP BY 1, 2),
        loss AS (SELECT size.lang, j, any_value(n_good) AS n_good, any_value(strata) AS strata, count(hit.first) AS lost
                 FROM size CROSS JOIN range(1, {len(quality_rules.RULES) + 1}) AS r(j)
                 LEFT JOIN hit ON hit.lang IS NOT DISTINCT FROM size.lang AND first <= j GROUP BY 1, 2),
        deep AS (SELECT lang, max(j) AS depth FROM loss WHERE lost <= {_ALPHA!r} * n_good
                   AND list_sum(list_transform(range(0, lost + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1)
                         - lgamma(n_good - i + 1) + i * ln({_ALPHA!r}) + (n_good - i) * ln(1 - {_ALPHA!r}))))
                       <= {quality_rules.DELTA!r} / strata GROUP BY 1),
        chosen AS (SELECT placed.* FROM placed JOIN deep ON deep.lang IS NOT DISTINCT FROM placed.lang WHERE place <= depth)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT ({_HIT}) AS kept
        FROM c""",
    "op5_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first FROM p)
        SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 8), lambda i: {_BASE32}), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to, true AS complete
        FROM f""",
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    "op11_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
        k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        held AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {line_dedup.LENGTH}
                 GROUP BY 1 HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST}),
        m AS (SELECT k.*, held.key IS NOT NULL AND k.doc_id <> keep AS lost FROM k LEFT JOIN held USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM m GROUP BY rid, doc_id""",
    "op12_lexical_search": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '{_TERM}') AS words
                   FROM documents),
        stat AS (SELECT count(*) FILTER (len(words) > 0) AS docs, sum(len(words))::BIGINT AS terms FROM d),
        t AS (SELECT doc_id, unnest(words) AS term, len(words) AS n FROM d),
        tf AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM t GROUP BY 1, 2),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '{_TERM}')) AS term
              FROM benchmark),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
              FROM tf, stat WHERE term IN (SELECT term FROM q) GROUP BY 1),
        s AS (SELECT item_id, doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT)
                AS score FROM q JOIN tf USING (term) JOIN w USING (term), stat GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {lexical_search.BEST}""",
    "op13_importance": f"""
        WITH RECURSIVE table_of AS (SELECT list(c ORDER BY i) AS crc FROM (
          SELECT i, list_reduce(list_concat([i], range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1
                   THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(0, 256) AS r(i))),
        d AS (SELECT row_number() OVER () AS rid, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '{_FEATURE}') AS words FROM documents),
        b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '{_FEATURE}')) AS word FROM benchmark),
        f AS (SELECT rid, unnest(words) AS word FROM d),
        word AS (SELECT DISTINCT word FROM (SELECT word FROM f UNION ALL SELECT word FROM b)),
        code AS (SELECT word, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, strlen(word)),
                   lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
                   lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket FROM word, table_of),
        s AS (SELECT bucket, count(*) AS n FROM f JOIN code USING (word) GROUP BY 1),
        t AS (SELECT bucket, count(*) AS n FROM b JOIN code USING (word) GROUP BY 1),
        total AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::BIGINT AS s, (SELECT coalesce(sum(n), 0) FROM t)::BIGINT AS t),
        gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (total.s + {importance.BUCKETS})
                   / ((s.n + 1)::DOUBLE * (total.t + {importance.BUCKETS})))) AS BIGINT) AS gain
                 FROM s LEFT JOIN t USING (bucket), total),
        w AS (SELECT rid, sum(gain)::BIGINT AS weight FROM f JOIN code USING (word) JOIN gain USING (bucket) GROUP BY 1),
        scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
                 + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN w USING (rid)),
        drawn AS (SELECT *, n_features >= {importance.LEAST_WORDS} AS fit, count(*) FILTER (n_features >= {importance.LEAST_WORDS}) OVER ()
                   AS fits, row_number() OVER (PARTITION BY n_features >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id) AS place
                  FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN fit AND place <= {importance.PERCENT} * fits // 100 THEN place END AS rank FROM drawn""",
}
