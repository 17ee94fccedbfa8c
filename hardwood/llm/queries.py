"""The operators as registered queries over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm import conversations, exact_dedup, html_text, language, mixing, pieces, pii, quality, quality_rules, simhash, substrings, toxicity, variants
from hardwood.llm.common import fold, table


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    """The vocabulary file: the folder $TOKENIZER_DIR if set, else the installed package."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


#: Target weights of the domains (here languages) in the mix; others keep their share. The mix repeats documents and drops none.
MIX_WEIGHTS = {"en": 0.50, "fr": 0.18, "de": 0.18, "es": 0.14}
LEAST_COPIES = 1


def learnable(labels: DataFrame, column: str, folds: int, held: int) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from: those outside the held-out fold."""
    return labels.filter(F.pmod(fold("doc_id"), F.lit(folds)) != held).select("doc_id", F.col(column).alias("label")).dropna()


def _scored(scores: DataFrame, folds: int, held: int) -> DataFrame:
    return scores.select(
        "doc_id", (F.pmod(fold("doc_id"), F.lit(folds)) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _scored(toxicity.score(docs, learnable(labels, "toxic", 5, 0)), 5, 0)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("row_key")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, learnable(docs, "lang", 4, 2))
    return language.predict(docs, model).select(
        "doc_id", (F.pmod(fold("doc_id"), F.lit(4)) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def domains(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("lang").alias("label")).dropna()


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domains are the languages: the only labels of these tables that say what a text is like and cover all its parts."""
    docs = table(spark, sf_dir, "documents")
    rates, _ = mixing.mix(docs, domains(docs), MIX_WEIGHTS, least=LEAST_COPIES)
    return rates.select("doc_id", "tokens", "posterior", "rate", "copies")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _scored(quality.score(docs, learnable(labels, "quality", 3, 1)), 3, 1)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage that a hash of conversation and turn decides: conv_id, turn, role, text, copies."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat_ws(":", *spaced).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter("fate != 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(damaged(rows), rows)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_exact_dedup, op3_html_extract, op4_quality_rules, op5_pii, op6_language_id, op7_mixing, op8_simhash, op9_sentencepiece,
        op10_quality_classifier, op11_substring_dedup, op12_conversation_repair, op13_spelling_variants,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _quality_rules_sql() -> str:
    r"""Windows and lines by unnesting; sketches as bucket counts at the three levels; fences from running counts, blended downwards."""
    measures, prior = quality_rules.MEASURES, quality_rules.PRIOR
    levels = {"own": "lang, source", "by_lang": "lang", "corpus": "1"}

    def told(k: int) -> str:
        return "CASE measure " + " ".join(f"WHEN '{m}' THEN {v[k]}" for m, v in measures.items()) + " END"

    quantiles = []
    for level, by in levels.items():
        named = "lang, source" if level == "own" else "lang, NULL AS source" if level == "by_lang" else "NULL AS lang, NULL AS source"
        quantiles.append(f"""
            SELECT '{level}' AS level, {named}, measure, max(total)::BIGINT AS n_rows, min(low) FILTER (WHERE 100 * upto >= {told(0)} * total) AS q_low,
                   min(low) FILTER (WHERE 100 * upto >= {told(1)} * total) AS q_high
            FROM (SELECT *, sum(n) OVER (PARTITION BY {by}, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {by}, measure) AS total
                  FROM (SELECT {by + ', ' if by != '1' else ''} measure, bucket, sum(n) AS n, min(low) AS low FROM sketch GROUP BY ALL) AS s) AS r
            GROUP BY ALL""")
    both = ", ".join(f"'{m}'" for m, v in measures.items() if v[3])

    def blended(side: str) -> str:
        by_lang = f"((g.n_rows * g.{side} + {prior} * c.{side}) // (g.n_rows + {prior}))"
        return f"(o.n_rows * o.{side} + {prior} * {by_lang}) // (o.n_rows + {prior})"

    return f"""
        WITH w AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '{quality_rules.BLANK}'), lambda x: x <> '') AS ws,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
            FROM documents),
        windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
                    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w) AS u),
        repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) AS x WHERE c > 1),
        covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
        counts AS (
            SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
                   (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
                   (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
            FROM w LEFT JOIN covered AS c ON c.rid = w.rid),
        rows_ AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1000 * word_chars // greatest(n_words, 1) AS mean_word,
                         1000 * (n_symbols + 3) // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
                         1000 * (n_repeat_words + 3) // greatest(n_words, 1) AS repeats
                  FROM counts),
        long AS ({" UNION ALL ".join(f"SELECT rid, lang, source, base_failed, {k} AS place, '{m}' AS measure, {m} AS value FROM rows_" for k, m in enumerate(measures))}),
        sketch AS (
            SELECT lang, source, measure, CASE WHEN value <= 0 THEN 0 ELSE 1 + ceil(ln(value::DOUBLE) / ln({quality_rules.GROWTH})) END AS bucket,
                   count(*) AS n, min(value) AS low
            FROM long WHERE NOT base_failed GROUP BY ALL),
        quantiles AS ({" UNION ALL ".join(quantiles)}),
        reaches AS (SELECT *, {told(2)} * greatest(q_high - q_low, ceil(q_high * {quality_rules.ERROR} / 100)::BIGINT) AS reach FROM quantiles),
        fences AS (
            SELECT level, lang, source, measure, n_rows, CASE WHEN measure IN ({both}) THEN greatest(q_low - reach, 0) ELSE 0 END AS low, q_high + reach AS high
            FROM reaches),
        judged AS (
            SELECT l.rid, string_agg(l.measure, ',' ORDER BY l.place) AS failed
            FROM long AS l
            JOIN fences AS o ON o.level = 'own' AND o.lang IS NOT DISTINCT FROM l.lang AND o.source IS NOT DISTINCT FROM l.source AND o.measure = l.measure
            JOIN fences AS g ON g.level = 'by_lang' AND g.lang IS NOT DISTINCT FROM l.lang AND g.measure = l.measure
            JOIN fences AS c ON c.level = 'corpus' AND c.measure = l.measure
            WHERE NOT l.base_failed AND (l.value < {blended("low")} OR l.value > {blended("high")})
            GROUP BY l.rid)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept,
               CASE WHEN base_failed THEN 'base' ELSE coalesce(failed, '') END AS failed
        FROM rows_ LEFT JOIN judged ON judged.rid = rows_.rid"""


#: CRC32 in SQL: the steps of all bytes, and the value for the bytes that ``x`` spells in hexadecimal digits.
_CRC_STEPS = """crc AS (
            SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
            FROM (SELECT unnest(range(256)) AS b) AS r)"""


def _crc(x: str) -> str:
    numbers = f"list_transform(range(length({x}) // 2), lambda i: ('0x' || {x}[2 * i + 1 : 2 * i + 2])::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {numbers}), lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295)"


def _repair_sql() -> str:
    """All conversations a row further in each round of a recursion, which keeps the least cost and audit of each state.

    Before a row and at the end, up to three rows are inserted: more lead through a state twice.
    """
    inserts = []
    for q in range(4):
        state, said = q, []
        for k in range(4):
            inserts.append(f"({q}, {k}, {state}, [{', '.join(said)}]::VARCHAR[])")
            letter = next(x for x in conversations.NAMES if (state, x) in conversations.NEXT)
            state = conversations.NEXT[state, letter]
            said.append(f"'{conversations.NAMES[letter]}:'")
    steps = ", ".join(f"({q}, '{letter}', {to})" for (q, letter), to in conversations.NEXT.items())
    return f"""
        WITH RECURSIVE {_CRC_STEPS},
        keyed AS (SELECT *, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x FROM conversations),
        dealt AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc('x')} % 20 AS fate FROM keyed, crc),
        damaged AS (
            SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM dealt WHERE fate <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
                   regexp_replace(text, '{quality_rules.BLANK}', '', 'g') AS seen
            FROM damaged),
        faulty AS (
            SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
                   CASE WHEN seen = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM placed),
        inserts(q, k, upto, said) AS (VALUES {', '.join(inserts)}),
        steps_(q, letter, upto) AS (VALUES {steps}),
        edits AS (
            SELECT conv_id, i, 0 AS q, 0 AS upto, 4 AS cost, 'D' AS edit, []::VARCHAR[] AS said FROM faulty
            UNION ALL SELECT conv_id, i, k, k, 4, 'D', [] FROM faulty, (VALUES (1), (2), (3)) AS s(k)
            UNION ALL SELECT conv_id, i, q, upto, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text]
                      FROM faulty JOIN steps_ ON letter = initial WHERE fault IN ('', 'truncated')
            UNION ALL SELECT conv_id, i, q, upto, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [CASE letter WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
                      FROM faulty JOIN steps_ ON letter IN ('u', 'a') WHERE fault IN ('', 'truncated')),
        ways AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'said': []::VARCHAR[]}} AS best FROM faulty
            UNION ALL
            SELECT w.conv_id, w.i + 1, e.upto, min({{'cost': (w.best).cost + 3 * n.k + e.cost, 'audit': (w.best).audit || repeat('I', n.k) || e.edit,
                                                    'said': list_concat(list_concat((w.best).said, n.said), e.said)}})
            FROM ways AS w JOIN inserts AS n ON n.q = w.q JOIN edits AS e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.q = n.upto
            GROUP BY w.conv_id, w.i, e.upto),
        counts AS (
            SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
                   count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY conv_id),
        ends AS (
            SELECT w.conv_id, min({{'cost': (w.best).cost + 3 * n.k, 'audit': (w.best).audit || repeat('I', n.k), 'said': list_concat((w.best).said, n.said)}}) AS best
            FROM ways AS w JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts AS n ON n.q = w.q AND n.upto IN (0, 3)
            GROUP BY w.conv_id)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce((best).cost, 0)::BIGINT AS cost,
               coalesce((best).audit, '') AS audit, sha256(coalesce(array_to_string((best).said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o
        LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends AS e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


#: The same results in SQL, where SQL can say them.
SQL = {
    "op2_exact_dedup": f"""
        WITH texts AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)""",
    "op4_quality_rules": _quality_rules_sql(),
    "op11_substring_dedup": f"""
        WITH w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '{quality_rules.BLANK}'), lambda x: x <> '') AS ws
                   FROM documents),
        windows AS (SELECT rid, doc_id, i, array_to_string(ws[i : i + 49], ' ') AS g
                    FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w) AS u),
        late AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM windows) AS x WHERE low < doc_id),
        covered AS (SELECT DISTINCT rid, i + k AS i FROM late, (SELECT unnest(range(50)) AS k) AS o),
        words AS (SELECT rid, i, ws[i] AS word FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) AS u),
        kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN covered USING (rid, i) GROUP BY rid)
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON kept.rid = w.rid""",
    "op12_conversation_repair": _repair_sql(),
    "op13_spelling_variants": f"""
        WITH RECURSIVE {_CRC_STEPS},
        runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
                 FROM documents),
        counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs GROUP BY ALL),
        hashed AS (
            SELECT run, n, {_crc('x')} AS h FROM counted, crc),
        deleted AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM deleted WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words) AS u),
        near AS (
            SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM words AS a JOIN cut AS b ON a.word = b.rest
            UNION SELECT b.word, b.n, a.word, a.n FROM words AS a JOIN cut AS b ON a.word = b.rest),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
        forms AS (SELECT word, n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM ranked WHERE place = 1),
        chain AS (
            SELECT word, form AS upper_form FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.upper_form WHERE forms.form IS NOT NULL),
        roots AS (SELECT word, arg_max(upper_form, times) AS root FROM (SELECT chain.word, upper_form, words.n AS times FROM chain JOIN words ON words.word = upper_form) AS c GROUP BY word)
        SELECT words.word, form, coalesce(root, words.word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM words LEFT JOIN forms ON forms.word = words.word LEFT JOIN roots ON roots.word = words.word""",
}
