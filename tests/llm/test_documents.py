"""Every operator on rows made to break it, and against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hardwood.llm import exact_dedup, html_text, language, mixing, pieces, pii, quality, quality_rules, simhash, subwords, toxicity, trees
from hardwood.llm.common import keep_rows, ready, row_key, staged
from hardwood.llm.components import components
from hardwood.llm.queries import tokenizer_file

# Extra columns named like those the operators use inside.
CLASHING = (
    "kept", "score", "row_key", "fp", "recipe", "names", "component_id", "words", "lines", "sorted", "x", "tokens", "posterior", "rate", "copies", "label",
    "mark_row", "mark_id", "mark_key", "mix_row", "mix_copies", "mix_one", "place", "candidates", "base", "spans", "digit", "ids", "n_words", "root", "met",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = " ".join(f"w{i % 97} and{i % 13}." for i in range(20000))
TEXTS = [
    None, "", " \t\n", "a", "A", "one two three", "One two THREE", LONG, LONG.upper(), "日本語 😀 \x00 é ﬁ", "the same", "the same",
    "Write a.b+c@mail.example.com or +1 (017) 555-7713 now.", "x " * 300, "line one\nline one\nline two\n\nline one",
]


@pytest.fixture(scope="module")
def hostile(spark):
    ready(spark)
    rows = [(i, t, ["en", None, "de"][i % 3], ["s", None][i % 2], None) for i, t in enumerate(TEXTS)]
    rows += [(None, "the same", None, None, 1), (None, "THE same", "en", "s", 1), (3, "a", "en", "s", 1), (10, "the same", "de", "s", 2)]
    return spark.createDataFrame([(*r, *(["clash"] * len(CLASHING))) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(hostile):
    return hostile.filter("false")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shape(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


# ------------------------------------------------------------- exact dedup


def test_chunks_cover_a_text_and_follow_its_content():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(200_000))
    ends = exact_dedup.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes[:-1].min() >= exact_dedup.LEAST and sizes.max() <= exact_dedup.MOST
    moved = exact_dedup.chunk_ends(b"some words in front" + data)
    chunks = {data[a:b] for a, b in zip([0, *ends], ends)}
    shifted = b"some words in front" + data
    shared = sum(shifted[a:b] in chunks for a, b in zip([0, *moved], moved))
    assert shared >= 0.8 * len(ends)
    assert exact_dedup.chunk_ends(b"") == [] and exact_dedup.chunk_ends(b"x") == [1]
    assert exact_dedup.chunk_ends(bytes(300_000))[-1] == 300_000


def test_exact_groups_on_hostile_rows(hostile, empty):
    rows = [(r.doc_id, lower(r.text)) for r in hostile.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    expected = Counter()
    for i, t in rows:
        keep = max((x for x in groups[t] if x is not None), default=None)
        expected[i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact_dedup.exact_groups(hostile).drop("row_key")
    assert Counter(map(tuple, got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())) == expected
    assert shape(exact_dedup.exact_groups(empty)) == shape(exact_dedup.exact_groups(hostile)) and exact_dedup.exact_groups(empty).isEmpty()


def test_one_row_of_each_text_stays_with_all_its_columns(hostile, empty):
    kept = exact_dedup.without_copies(hostile)
    assert kept.columns == hostile.columns
    rows = kept.collect()
    assert sorted(lower(r.text) for r in rows) == sorted({lower(r.text) for r in hostile.collect()})
    assert all(r.mark_row == "clash" for r in rows)
    assert exact_dedup.without_copies(empty).isEmpty()


def test_names_that_stand_for_several_proofs_are_told_apart(spark, monkeypatch):
    """With chunk names cut to nothing, only the proofs differ."""
    docs = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "ALPHA"), (4, "")], "doc_id long, text string")
    whole = exact_dedup.batch_pass

    def nameless(df, schema, make):
        passed = whole(df, schema, make)
        return passed.withColumn("names", F.transform("names", lambda x: F.lit(7).cast("long"))) if "names" in passed.columns else passed

    monkeypatch.setattr(exact_dedup, "batch_pass", nameless)
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()}
    assert got == {1: 3, 2: 2, 3: 3, 4: 4}


# ----------------------------------------------------------------- simhash


def plain_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text).encode())
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] if words else []
    values = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum((2 * sum(v >> b & 1 for v in values) > len(values)) << b for b in range(64))


def brute_components(prints):
    """prints: (doc_id, fingerprint) rows; the smallest id reachable, by row."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low.get(find(i)) for i in range(len(prints))]


def test_near_groups_on_hostile_rows(hostile, empty):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in hostile.collect()]
    expected = Counter((i, f"{fp:016x}", c) for (i, fp), c in zip(rows, brute_components(rows)))
    got = simhash.near_groups(hostile)
    assert Counter(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect())) == expected
    assert simhash.near_groups(empty).isEmpty() and simhash.without_near_copies(empty).isEmpty()
    kept = simhash.without_near_copies(hostile)
    assert kept.columns == hostile.columns
    assert len(kept.collect()) == len({simhash.fingerprint(r.text) for r in kept.collect()})


def test_links_are_all_pairs_within_four_bits(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        center = rng.getrandbits(64)
        prints.add(center)
        for _ in range(8):  # variants up to six bits away, on random and on chosen bytes
            value = center
            for _ in range(rng.randrange(7)):
                value ^= 1 << (rng.randrange(64) if rng.random() < 0.6 else rng.randrange(8) * 8)
            prints.add(value)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    expected = {
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4
    }
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = simhash.links(simhash.postings(distinct)).collect()
    assert sorted(map(tuple, found)) == sorted(expected)  # each once
    low = dict(zip(signed, brute_components([(s, s & ((1 << 64) - 1)) for s in signed])))
    roots = dict(map(tuple, simhash.roots_of(distinct).distinct().collect()))
    assert all(roots.get(s, s) == low[s] for s in signed)


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 30)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).distinct().collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 30)}, **{i: 200 for i in range(200, 203)}}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# ------------------------------------------------------------------ pieces


def test_coding_is_the_librarys(hostile, empty):
    vocab = pieces.vocabulary(tokenizer_file())
    rng = random.Random(5)
    alphabet = "ab \n▁\t.é日😀\x00<>s/0x"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    texts += ["<s> </s> <unk> <0x0A>", "▁▁a ▁", "   \n   ", "x" * 5000, "é" * 3000]
    for text, (packed, odd) in zip(texts, pieces.coder(tokenizer_file())(texts)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert odd == 0 and ids == vocab.library.encode(text, add_bos=True, add_eos=True)
        assert [vocab.begin, *vocab.encode(text), vocab.end] == ids  # the heap alone
        assert vocab.decode(ids) == vocab.library.decode(ids)
    rows = pieces.digest_documents(hostile, tokenizer_file()).collect()
    expected = Counter()
    for r in hostile.collect():
        ids = vocab.library.encode(r.text or "", add_bos=True, add_eos=True)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(vocab.library.decode(ids).encode()).hexdigest(), 0] += 1
    assert Counter(map(tuple, rows)) == expected
    tokens = pieces.encode_documents(hostile, tokenizer_file())
    texts = Counter((r.doc_id, (r.text or "")) for r in hostile.collect())
    assert Counter(map(tuple, pieces.decode_documents(tokens, tokenizer_file()).collect())) == texts
    assert all(r.round_trip for r in tokens.collect())
    assert pieces.digest_documents(empty, tokenizer_file()).isEmpty()


def test_the_library_checks_and_does_not_code(monkeypatch):
    vocab = pieces.MergeVocabulary(tokenizer_file())
    monkeypatch.setattr(pieces, "vocabulary", lambda _: vocab)
    text = "some words, some " + "long" * 200
    right = [vocab.begin, *vocab.encode(text), vocab.end]
    assert vocab.decode_checked(right) == (text, False)
    monkeypatch.setattr(vocab, "by_library", lambda parts: [[vocab.unknown] for _ in parts])
    [(packed, odd)] = pieces.coder.__wrapped__(tokenizer_file())([text])
    assert np.frombuffer(packed, "<u4").tolist() == right and odd == len(vocab.cut(text))
    vocab.bytes_of[right[1]] += b"!"
    assert vocab.decode_checked(right)[1]


# ----------------------------------------------------------- quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_base_counts_on_hostile_rows(hostile, empty):
    got = quality_rules.judge(hostile)
    expected = Counter((r.doc_id, *plain_counts(r.text)) for r in hostile.collect())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(map(tuple, got.select(*names).collect())) == expected
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and (not r.base_failed or not r.kept) for r in got.collect())
    assert quality_rules.judge(empty).isEmpty()


def test_thresholds_follow_the_group(spark):
    """Sources with many symbols are measured by their own kind; a stray one is not."""
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]

    def text(marks):
        return " ".join(rng.choice(vocabulary) + "#" * (rng.random() < marks) for _ in range(80))

    rows = [(i, text(0.5), "en", "code") for i in range(300)] + [(i, text(0), "en", "prose") for i in range(300, 600)]
    rows += [(600, text(0.9), "en", "prose"), (601, text(0.5), "en", "code"), (602, text(0.5), None, None), (603, text(0), "fr", "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert not kept[600] and kept[601] and kept[603] and sum(kept[i] for i in range(600)) > 590


def test_every_fence_moves_with_language_and_source(spark):
    """On the given texts no fence is a constant, and the sketch's own error, the only least distance, hardly ever decides."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
        held = quality_rules.thresholds(staged(quality_rules.with_measures(quality_rules.measured(docs)), "measured")).collect()
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
    for measure, (_, _, _, both) in quality_rules.MEASURES.items():
        for side in ("floor", "ceiling") if both else ("ceiling",):
            by_lang = {}
            for r in held:
                by_lang.setdefault(r.t_lang, set()).add(r[f"{side}_{measure}"])
            assert len(by_lang) == 4 and len(set(map(frozenset, by_lang.values()))) == 4
            assert all(len(values) > 1 for values in by_lang.values()), (measure, side)


def test_small_groups_lean_on_their_parents_by_count(spark):
    """Own and parent fences are averaged by rows and PRIOR: held against the same arithmetic on plain numbers."""
    rows = spark.createDataFrame([(own, n, parent) for own in (0, 7, 1000) for n in (1, 99, 100, 10**9) for parent in (0, 13, 999)], "own long, n long, parent long")
    got = rows.select("own", "n", "parent", quality_rules.blended(F.col("own"), F.col("n"), F.col("parent")).alias("b")).collect()
    assert all(r.b == (r.n * r.own + quality_rules.PRIOR * r.parent) // (r.n + quality_rules.PRIOR) for r in got)


def test_sketches_merge_to_the_sketch_of_the_whole(spark):
    rows = spark.range(5000).selectExpr("id % 7 as lang", "id % 3 as source", "false as base_failed", *(f"(id * id) % 1009 as {m}" for m in quality_rules.MEASURES))
    parts = quality_rules.merged(quality_rules.sketches(rows), "lang")
    whole = quality_rules.sketches(rows.withColumn("source", F.lit(0))).drop("source")
    order = ["lang", "measure", "bucket"]
    assert parts.orderBy(*order).select(*order, "n", "low").collect() == whole.orderBy(*order).select(*order, "n", "low").collect()


# --------------------------------------------------------------------- pii


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m[0])] for k, p, ok in kinds]


def test_base_spans_are_those_of_the_plain_patterns(spark, hostile, empty):
    rng = random.Random(8)
    parts = ["a@b.com", "@", ".", "x.y_z%+-", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "-", "  ",
             "+1 (017) 555-7713", "+", "😀é", "7", "token = \"d377c9aa056ab85cf58c4e299cff1736db855bb1\"", "123-45-6789", "c@d", "e.f@g.h-i.jk", "\n"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(400)]
    texts += ["a" * 30000, "1" * 30000, "1 " * 30000, "a@" + "b." * 20000 + "c", "+" * 3000, "+1" + "(" * 20000 + "2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(hostile.select("doc_id", "text"))
    expected = Counter()
    for r in docs.collect():
        found = plain_spans(r.text)
        expected[r.doc_id, *map(len, found), ",".join(s for f in found for s in f)] += 1
    got = pii.find(docs)
    assert Counter(map(tuple, got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans").collect())) == expected
    for r in got.collect():
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))
        keys = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in r.spans.split(",") if s]
        assert keys == sorted(keys)
    assert pii.find(empty).isEmpty()


def test_keys_and_split_cards_are_added(spark):
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'the token = "{key()}" is here and no more') for i in range(40)]
    rows += [(100, "pay 4111111111111111 5500000000000004 now"), (101, "the version 20 of chapter 7 has 300 pages"), (102, "plain words only")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "secret:13:53" for i in range(40))
    assert got[100] == "card:4:20,card:21:37" and got[101] == got[102] == ""


def added(found, kind):
    """Spans of a kind that the method added to the base ones, by document."""
    spans = lambda x: {s for s in x.split(",") if s.startswith(kind + ":")}
    return {r.doc_id: sorted(spans(r.spans) - spans(r.base_spans)) for r in found.collect()}


def test_numbers_that_fail_their_check_digits_are_no_cards(spark):
    rng = random.Random(6)
    junk = []
    while len(junk) < 300:
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        junk += [] if luhn(digits) else [digits]
    rows = [(i, f"of thore {d} and the rest") for i, d in enumerate(junk)]
    alone = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    assert not any(added(alone, "card").values())
    rows += [(1000 + i, f"the card 4111111111111111 {d}") for i, d in enumerate(junk[:20])] + [(2000, "pay 4111111111111111 5500000000000004 now")]
    found = added(pii.find(spark.createDataFrame(rows, "doc_id long, text string")), "card")
    assert found.pop(2000) == ["card:21:37", "card:4:20"]
    assert {k: v for k, v in found.items() if v} == {1000 + i: ["card:9:25"] for i in range(20)}


def test_national_phones_and_late_digits(spark):
    rng = random.Random(7)
    two = lambda: f"{rng.randrange(100):02d}"
    french = [f"appelez le 06 {two()} {two()} {two()} {two()} ce soir" for _ in range(30)]
    german = [f"Anruf unter 0171 {rng.randrange(10**6, 10**7)} heute" for _ in range(30)]
    late = "x" * 150 + "1" + "abcdef"
    rows = list(enumerate(french + german)) + [(100, f"key {late}"), (101, "in 2010 and 2011 were 300 400 books"), (102, "the sum 12 34 56 78 90")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    phones = added(found, "phone")
    assert all(phones[i] == ["phone:11:25"] for i in range(30)) and all(phones[i] == ["phone:12:24"] for i in range(30, 60))
    assert phones[101] == phones[102] == []
    read = {r.doc_id: [c.votes for c in r.candidates] for r in pii.read(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(read[100]) == 1


def test_a_labeler_that_always_says_yes_counts_for_nothing():
    rng = random.Random(3)
    counts = Counter()
    for _ in range(4000):
        truth = 1 if rng.random() < 0.3 else -1
        counts[0, (*(truth if rng.random() < p else -truth for p in (0.95, 0.9, 0.85)), 0, 1)] += 1
    share, rates, belief = pii.estimate([(k, v, n) for (k, v), n in counts.items()])
    assert abs(share[0] - 0.3) < 0.05 and abs(rates[0, 4, 1, True] - rates[0, 4, 1, False]) < 0.02
    assert belief[0, (-1, -1, -1, 0, 1)] < 0.05 and belief[0, (1, 1, 1, 0, 1)] > 0.95


def test_account_numbers_by_their_check_digits(spark):
    rows = [("DE89370400440532013000",), ("GB82WEST12345698765432",), ("DE88370400440532013000",), ("FR1420041010050500013M02606",)]
    assert [r[0] for r in spark.createDataFrame(rows, "v string").select(pii._rest97(F.col("v")) == 1).collect()] == [True, True, False, True]


def test_no_false_card_is_added_on_the_given_texts(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8).select("doc_id", "text")
        found = pii.find(docs)
        extra = {i: spans for i, spans in added(found, "card").items() if spans}
        texts = {r.doc_id: r.text for r in docs.filter(F.col("doc_id").isin(list(extra) or [-1])).collect()}
        values = [texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, spans in extra.items() for s in spans]
        assert all(luhn(re.sub("[^0-9]", "", v)) for v in values)
        assert sum(map(len, added(found, "secret").values())) >= 150
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_reliabilities_find_the_good_labelers():
    rng = random.Random(1)
    counts = Counter()
    for _ in range(4000):
        truth = 1 if rng.random() < 0.4 else -1
        votes = tuple(truth if rng.random() < p else -truth for p in (0.95, 0.9, 0.85, 0.6, 0.7))
        counts[0, votes] += 1
    share, right, belief = pii.reliabilities([(k, v, n) for (k, v), n in counts.items()])
    assert abs(share[0] - 0.4) < 0.05 and np.abs(np.array(right) - (0.95, 0.9, 0.85, 0.6, 0.7)).max() < 0.06
    assert belief[0, (1, 1, 1, 1, 1)] > 0.95 > 0.05 > belief[0, (-1, -1, -1, -1, -1)]
    assert pii.reliabilities([]) == ({}, [pii.START] * len(pii.LABELERS), {})


# ------------------------------------------------------------- classifiers


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.05)).astype(int)
    model = trees.boost(x[:2000], y[:2000])
    model.steps = trees.isotonic(model.margin(x[2000:2500]), y[2000:2500])
    score = model.score(x[2500:])
    assert ((score >= 0.5) == y[2500:]).mean() > 0.9 and score.min() >= 0 and score.max() <= 1
    assert abs(score.mean() - y[2500:].mean()) < 0.06
    alone = trees.boost(x[:10], np.ones(10))
    assert np.allclose(alone.score(x), 11 / 12) and trees.isotonic(np.zeros(3), np.zeros(3)) is None
    margins, labels = np.array([0.0, 1, 2, 3]), np.array([0, 1, 0, 1])
    knots = trees.isotonic(margins, labels)
    assert (np.diff(knots[1]) >= 0).all()
    tied = trees.isotonic(np.zeros(10), np.array([0] * 8 + [1] * 2))
    assert np.allclose(tied, [[0], [0.2]])


def labelled(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, label int")


def test_toxicity_learns_words_beyond_the_lexicon(spark, hostile, empty):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]

    def text(bad):
        found = [rng.choice(words) for _ in range(40)]
        for _ in range(3 if bad else 0):
            found.insert(rng.randrange(40), rng.choice(["zorkling", "zorkles", "you idiot"]))
        return " ".join(found)

    texts = [(text(i % 4 == 0), int(i % 4 == 0)) for i in range(600)]
    docs, labels = labelled(spark, texts)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, labels.filter("doc_id < 450")).collect()}
    right = [(scores[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(texts) if i >= 450]
    assert np.mean(right) > 0.95 and all(0 <= s <= 1 for s in scores.values())
    kept = toxicity.without_toxic(hostile, spark.createDataFrame([], "doc_id long, label int"))
    assert kept.columns == hostile.columns
    for rows in (labels, labels.filter("label = 0"), labels.filter("false")):
        assert toxicity.score(hostile, rows).count() == hostile.count()
    assert toxicity.score(empty, labels).isEmpty() and toxicity.without_toxic(empty, labels).isEmpty()


def test_toxicity_features_see_through_disguise():
    reader = toxicity.Reader({})
    at = {n: i for i, n in enumerate(toxicity.FEATURES)}
    plain, masked, drawn = (reader.row(f"you are an {w} my friend") for w in ("idiot", "1d10t", "idiooooot"))
    assert plain[at["insult_density"]] > 0 and plain[at["near_density"]] > 0
    assert masked[at["hidden_density"]] > 0 and masked[at["near_density"]] > 0 and drawn[at["drawn_density"]] > 0
    assert reader.row(None) == reader.row(" ") == [0.0] * len(toxicity.FEATURES)


def test_capital_words_count_in_every_text():
    reader = toxicity.Reader({})
    words, rate = (toxicity.FEATURES.index(f) for f in ("capital_word_rate", "capital_rate"))
    plain = "quiet words " * 45
    for shout in ("GO AWAY FROM ALL THIS NOW OR ELSE YES", "ÉÀ ÖÜ ÉÀ ÖÜ ÉÀ ÖÜ ÉÀ ÖÜ ÉÀ", "ДА НЕТ ДА НЕТ ДА НЕТ ДА НЕТ ДА"):
        for around in ("", plain):
            text = around + shout
            row = reader.row(text)
            assert row[words] == len(shout.split()) / len(text.split())
            assert row[rate] == sum(map(str.isupper, text)) / len(text)


def test_quality_separates_junk(spark, hostile, empty):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(500)]

    def text(good):
        found = [rng.choice(words) for _ in range(60)]
        return " ".join(found if good else [w.upper() + "!!" for w in found[:10] * 4])

    texts = [(text(i % 3 > 0), int(i % 3 > 0)) for i in range(300)]
    docs, labels = labelled(spark, texts)
    scores = {r.doc_id: r.score for r in quality.score(docs, labels.filter("doc_id < 200")).collect()}
    assert all((scores[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(texts))
    for rows in (labels.filter("label = 1"), labels.filter("false"), labels.unionByName(labels)):
        assert quality.score(hostile, rows).count() == hostile.count()
    assert quality.score(empty, labels).isEmpty()


def test_discriminant_is_the_difference_of_log_densities():
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    x = [rng.normal(size=(400, d)), rng.normal(1, 2, size=(500, d))]
    model = quality.fit([(float(len(v)), v.sum(axis=0), v.T @ v) for v in x])
    pooled = sum(np.cov(v.T) * (len(v) - 1) for v in x) / (sum(map(len, x)) - 2)
    point = rng.normal(size=(5, d))
    density = []
    for v in x:
        cov = (1 - quality.POOLED - quality.DIAGONAL) * np.cov(v.T) + quality.POOLED * pooled + quality.DIAGONAL * np.diag(np.diag(pooled)) + quality.FLOOR * np.eye(d)
        gone = point - v.mean(axis=0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", gone, np.linalg.inv(cov), gone) - 0.5 * np.linalg.slogdet(cov)[1])
    prior = 501 / 902
    expected = 1 / (1 + np.exp(-(quality.TEMPER * (density[1] - density[0]) + np.log(prior / (1 - prior)))))
    assert np.allclose(model.score(point), expected)


def test_languages_are_told_apart_and_others_marked(spark, hostile, empty):
    rng = random.Random(9)
    kinds = {"aa": "abcde", "bb": "vwxyz"}
    rows = [
        (i, " ".join("".join(rng.choice(kinds[k]) for _ in range(5)) for _ in range(20)), k if i < 60 else None)
        for i, k in enumerate(["aa", "bb"] * 40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, docs.select("doc_id", F.col("lang").alias("label")).dropna())
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert all(got[i].lang_pred == ["aa", "bb"][i % 2] and got[i].score > 0.9 for i in range(80))
    odd = {r.doc_id: r for r in language.predict(hostile.filter("doc_id < 3 or doc_id = 9"), model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 and odd[i].rejected for i in (0, 1, 2))
    assert odd[9].lang_pred in kinds
    nothing = language.fit(docs, docs.select("doc_id", F.col("lang").alias("label")).filter("false"))
    assert {r.lang_pred for r in language.predict(hostile, nothing).collect()} == {"und"}
    assert language.predict(empty, model).isEmpty()


def test_word_shares_add_up_to_the_mean_of_subwords():
    rng = np.random.default_rng(3)
    model = subwords.SubwordModel(["a", "b"], rng.normal(size=(subwords.BUCKETS, 2)).astype(np.float32), np.array([0.5, -0.5]))
    text = "Straße größer 42 été été"
    buckets, _ = subwords.subwords(subwords.letters(text))
    assert np.allclose(model.logits([text, None, "7"], {}), [model.table[buckets].mean(axis=0) + model.bias, model.bias, model.bias], atol=1e-5)


# ------------------------------------------------------------------ mixing


def test_rates_reach_targets_and_stay_at_zero_or_more(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(500):
        a = rng.randrange(mixing.GRID + 1)
        b = rng.randrange(mixing.GRID + 1 - a)
        rows.append((rng.randrange(300), [a, b, mixing.GRID - a - b]))
    shares = spark.createDataFrame(rows, "tokens long, posterior array<int>")
    fitted = mixing.fit_rates(shares, ["a", "b", "c"], {"a": 0.5, "b": 0.3, "c": 0.2}, 60000.0)
    t, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]) / mixing.GRID
    rates = np.array([r.rate for r in shares.withColumn("rate", fitted.rate(F.col("posterior"))).collect()])
    assert rates.min() >= 0 and np.allclose(rates * t @ p, [30000, 18000, 12000], rtol=1e-3)
    # The same steps in numpy.
    now, own = t @ p, np.ones(len(t))
    for g in fitted.gradients:
        assert np.allclose(g, (own * t @ p - [30000, 18000, 12000]) / now, atol=1e-9)
        own = np.maximum(0, own - p @ g)
    assert np.allclose(own, rates)
    extreme = mixing.fit_rates(shares, ["a", "b", "c"], {"a": 1.0, "b": 0.0, "c": 0.0}, 1000.0)
    far = shares.withColumn("rate", extreme.rate(F.col("posterior")))
    assert far.agg(F.min("rate")).first()[0] == 0


def test_mixing_hostile_rows(spark, hostile, empty):
    labels = spark.createDataFrame([(5, "en"), (7, "en"), (12, "de"), (13, "de")], "doc_id long, label string")
    rates, fitted = mixing.mix(hostile, labels, {"de": 0.5, "en": 0.5}, least=1)
    assert rates.count() == hostile.count() and rates.filter("copies < 1").isEmpty()
    mixed = mixing.mixed(hostile, labels, {"de": 0.5, "en": 0.5}, least=1)
    assert mixed.columns == hostile.columns and mixed.count() == rates.agg(F.sum("copies")).first()[0]
    none = mixing.mixed(hostile, labels.filter("false"), {})
    assert none.count() == hostile.count()
    assert mixing.mixed(empty, labels, {"de": 1.0}).isEmpty()


def test_copies_follow_the_rate(spark):
    rows = spark.range(20000).withColumn("c", mixing.copies(F.lit(1.3), F.col("id")))
    assert abs(rows.agg(F.avg("c")).first()[0] - 1.3) < 0.02


# -------------------------------------------------------------------- html


ARTICLE = "<article><h1>Title</h1><p>One &amp; two<br>three <b>bo</b>ld <p>un\n closed<ul><li>a<li>b</ul></article>"
FURNITURE = [
    "<nav><a href='/'>menu</a></nav>", "<header>site</header>", "<footer>&copy; foot</footer>", "<aside>side</aside>", "<div class='ad'>buy</div>",
    "<form><label>q</label><input></form>", "<script>var t='</p><p>no';</script>", "<style>p{}</style>", "<div id='comments'><p>first!</p></div>",
    "<div class='cookie-notice'>ok?</div>", "<!-- <p>gone</p> -->", "<div role='navigation'>skip</div>", "<div hidden>unseen</div>",
]


def test_articles_come_out_of_their_pages():
    for seed in range(20):
        around = FURNITURE[:]
        random.Random(seed).shuffle(around)
        html = f"<html><head><title>t</title></head><body>{''.join(around[:6])}{ARTICLE}{''.join(around[6:])}</body></html>"
        assert html_text.Page(html).blocks() == "Title One & two three bold un closed a b"
        plain = html.replace("<article>", "<div class=text>").replace("</article>", "</div>")
        assert html_text.Page(plain).blocks() == "Title One & two three bold un closed a b"
    for broken in ("", "<", "<p", "a < b", "</p>x", "<div><p>x</div>y", "<p>x</span></p", "<a title='x>y'>z", "<a title='x>y", "&#x41;&nbsp;&am"):
        assert isinstance(html_text.Page(broken).blocks(), str)
    assert html_text.Page("<p>x</p>y<p>z").blocks() == "x y z"
    assert html_text.Page("<article><header><h1>T</h1></header><p>x</p></article>").blocks() == "T x"
    assert html_text.Page("<p>a</p>" * 30000).blocks() == " ".join("a" * 30000)


def test_names_do_not_cut_an_article():
    story, other = "a story of many words " * 20, "<div class=site-footer>foot</div><div class='ad-slot'>buy</div>"
    for name in ("content-sidebar-wrap", "no-sidebar", "has-ads", "social-science", "sidebar", "post tag-social"):
        for inner in (f"<article><p>{story}</p></article>", f"<p>{story}</p>", f"<div><p>{story}</p><p>{story}</p></div>"):
            html = f"<body><div id=menu>go</div><div class='{name}'>{inner}</div>{other}</body>"
            assert html_text.Page(html).blocks() == " ".join([story.strip()] * inner.count(story))
    part = f"<section class=social-science><p>{story}</p></section>"
    assert html_text.Page(f"<div>{part}<section><p>{story}</p><p>{story}</p></section></div>").blocks() == " ".join([story.strip()] * 3)
    cards = "<article class=card>read on</article>" * 30
    for around in ("{}", "<p>{}</p>", "<div>{}</div>", "<div><div><p>{}</p></div></div>"):
        assert story.strip() in html_text.Page(f"<body>{around.format(story)}{cards}</body>").blocks()
        assert html_text.Page(f"<body>{around.format('go on')}<article>{story}</article></body>").blocks() == story.strip()
    comments = f"<div id=comments><article class=comment>{story * 3}</article></div>"
    assert html_text.Page(f"<body><article>{story}</article>{comments}</body>").blocks() == story.strip()
    links = "<div class='post-related'><a>one more</a> <a>and more</a></div>"
    assert html_text.Page(f"<body><p>{story}</p>{links}</body>").blocks() == story.strip()


def test_letters_that_grow_in_lower_case_move_no_end_tag():
    script = "<SCRIPT>var s = '\u0130</scripted>' + 1 > 0;</Script >"
    html = f"<title>{'\u0130' * 9}</title><p>{'\u0130' * 40}</p>{script}<p>one</p>{script}<p>two</p><style>p>a{{}}</style>x"
    assert html_text.Page(html).blocks() == f"{'\u0130' * 40} one two x"


def test_what_a_site_repeats_is_cut(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]

    def page(i, host, box):
        text = " ".join(rng.choice(words) for _ in range(30))
        return (i, f"http://{host}/p{i}", f"<body><div class=strip><p>{box}</p></div><div class=text><p>{text}</p></div></body>", text)

    rows = [page(i, "a.example.com", "Read our terms of use before you go on") for i in range(40)]
    rows += [page(i, "b.example.com", " ".join(rng.choice(words) for _ in range(8))) for i in range(40, 80)]
    copies = page(0, "c.example.com", "short")
    rows += [(i, "http://c.example.com/x", copies[2], "short " + copies[3]) for i in range(80, 110)]
    rows += [(200, None, "<p>no host</p>", "no host"), (201, "http://a.example.com/", None, ""), (None, "bad", "<p>x", "x")]
    pages = spark.createDataFrame([r[:3] + ("t",) for r in rows], "page_id long, url string, html string, text string").repartition(4)
    got = {(r.page_id, r.url): r for r in html_text.main_text(pages).collect()}
    for i, url, html, text in rows:
        found = got[i, url]
        if i is not None and 40 <= i < 80:
            assert found.text.endswith(text) and len(found.text) > len(text)
        else:
            assert found.text == text
        assert found.n_chars == len(found.text)
    assert html_text.main_text(pages.filter("false")).isEmpty()
    same = html_text.main_text(pages.limit(2).unionAll(pages.limit(2)))
    assert same.count() == 4


def test_parts_of_names_are_evidence(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]

    def told(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = []
    for i in range(40):  # the box has one of six texts: cut by name and count together, by neither alone
        text, box = [told(30), told(30)], f"one of the six boxes of this site: {i % 6}"
        for host, name in (("hinted", "x-widget"), ("plain", "x-part")):
            html = f"<div class={name}>{box}</div><div class=social-science>{text[0]}</div><div>{text[1]}</div>"
            rows.append((len(rows), f"http://{host}.example.com/{i}", html, " ".join(text if host == "hinted" else [box, *text])))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_what_pages_share_does_not_make_them_one(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]

    def told(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = []
    for host in range(30):  # two own passages and six shared ones: nearly all pages once took the hash of a shared one
        boxes = [told(8) for _ in range(6)]
        for i in range(12):
            own = [told(25), told(25)]
            strip, text = ("".join(f"<p>{x}</p>" for x in xs) for xs in (boxes, own))
            rows.append((len(rows), f"http://h{host}.example.com/{i}", f"<body><div class=strip>{strip}</div><div class=text>{text}</div></body>", " ".join(own)))
    article = told(80)
    for host, others in (("only", 0), ("mixed", 40)):  # copies but for the time they were read at
        for i in range(30 + others):
            text, stamp = article if i < 30 else told(80), f"read at {i}"
            rows.append((len(rows), f"http://{host}.example.com/{i}", f"<body><div class=text><p>{text}</p></div><div class=time>{stamp}</div></body>", f"{text} {stamp}"))
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert got == {r[0]: r[3] for r in rows}


# ------------------------------------------------------------------ helpers


def test_keep_rows_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (None, "a", "z"), (2, None, "q")], "doc_id long, text string, mark_id string")
    verdicts = docs.select("doc_id", row_key().alias("row_key"), (F.coalesce("text", F.lit("")) != "b").alias("kept"))
    got = keep_rows(docs, verdicts)
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for r in docs.distinct().collect() if r.text != "b"]))
