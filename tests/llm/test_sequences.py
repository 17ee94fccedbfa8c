"""Substring dedup, conversation repair and spelling variants: against brute force, on hostile rows, and with hot groups split."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hardwood.llm import common, conversations, substrings, variants
from hardwood.llm.common import ready
from hardwood.llm.queries import damaged

CLASHING = ("row_key", "edges", "links", "flags", "spans", "n", "low", "name", "kept_sha256", "copies_", "m", "head", "tail", "known", "conv", "kind", "audit", "root")
DOCS = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)


def frame(spark, rows, parts=3):
    ready(spark)
    return spark.createDataFrame([(*r, *(["clash"] * len(CLASHING))) for r in rows], DOCS).repartition(parts)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------ substrings


def removed_by_force(rows, window=50):
    """doc_id, n_words, n_removed, digest of each row, by all windows of all rows."""
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for doc_id, words in split:
        if doc_id is not None:
            for k in range(len(words) - window + 1):
                g = tuple(words[k : k + window])
                first[g] = min(first.get(g, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        gone = set()
        if doc_id is not None:
            for k in range(len(words) - window + 1):
                if first[tuple(words[k : k + window])] < doc_id:
                    gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((doc_id, len(words), len(gone), sha(" ".join(kept))))
    return sorted(out, key=repr)


def passage_rows(seed):
    """Texts made of shared and own passages, periodic ones, copies, and ones cut off in a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 4)))
    shared = [" ".join(word() for _ in range(n)) for n in (49, 50, 51, 65, 120, 300)]
    rows = []
    for doc_id in rng.sample(range(1000), 60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                parts.append(rng.choice(shared))
            elif kind < 0.6:
                parts.append(" ".join(["x y"] * rng.randint(10, 60)))
            else:
                parts.append("\t".join(word() for _ in range(rng.randint(1, 80))))
        text = "  ".join(parts)
        rows.append((doc_id, text))
        if rng.random() < 0.2:
            rows.append((rng.randint(0, 1000), text[rng.randint(0, 40) :]))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_words_against_all_windows(spark, seed):
    rows = passage_rows(seed)
    rows += [(5, None), (6, ""), (7, " \n"), (None, rows[0][1]), (rows[1][0], rows[0][1]), rows[2], rows[2], (8, "é\x0bü " * 200)]
    found = substrings.without_repeats(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == removed_by_force(rows)
    assert any(r.n_removed for r in found)


def test_a_passage_of_a_third_of_all_rows_is_met_by_broadcast(spark, monkeypatch):
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(i, " ".join(f"o{rng.random()}" for _ in range(70)) + (f" {passage}" if i % 3 == 0 else "")) for i in range(150)]
    rows += [(1000 + i, passage) for i in range(3)]
    expected = removed_by_force(rows)
    for share in (2, 10_000):  # everything is seldom, everything is hot
        monkeypatch.setattr(common, "HOT_SHARE", share)
        assert sorted((tuple(r) for r in substrings.without_repeats(frame(spark, rows)).collect()), key=repr) == expected


def test_paths_compact_what_does_not_branch(spark):
    """Copies are one record from end to end; the windows around one differing word get their own."""
    rng = random.Random(5)
    words = [f"w{rng.random()}" for _ in range(400)]
    rows = frame(spark, [(1, " ".join(words)), (2, " ".join(words)), (3, "alone " * 10)])
    flagged = substrings.repeated_edges(substrings.graph(rows))
    texts = rows.withColumn("row_key", common.row_key()).select("doc_id", "row_key", "text").join(flagged, ["doc_id", "row_key"])
    assert sorted((r.doc_id, r.start, r.length) for r in substrings.records(texts).collect()) == [(1, 0, 400), (2, 0, 400)]
    other = [*words[:200], "new", *words[201:]]
    rows = frame(spark, [(1, " ".join(words)), (2, " ".join(words)), (4, " ".join(other))])
    flagged = substrings.repeated_edges(substrings.graph(rows))
    texts = rows.withColumn("row_key", common.row_key()).select("doc_id", "row_key", "text").join(flagged, ["doc_id", "row_key"])
    records = substrings.records(texts).collect()
    assert {r.doc_id for r in records if r.length > 50} == {1, 2, 4} and len(records) < 3 * 350 / 2


def test_equal_windows_select_equal_edges():
    rng = random.Random(6)
    words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(300)]
    memory = substrings._WordHashes()
    whole = substrings.Words(" ".join(words), memory)
    for start in range(0, 250, 7):
        part = substrings.Words(" ".join(words[start : start + 50]), memory)
        assert part.least[0] == whole.least[start]
        chosen = whole.hashes[whole.selected]
        assert whole.least[start] in chosen
    assert len(substrings.Words("a " * 49, memory).selected) == 0


# --------------------------------------------------------- conversations


CONVERSATIONS = "conv_id long, turn long, role string, text string, known string, conv string, part string, audit string, name string"


def talk(spark, rows, parts=3):
    ready(spark)
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], CONVERSATIONS).repartition(parts)


def faulty_rows(rows):
    """(initial, fault, role, text) of one conversation's rows, in order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault, role, text))
    return out


def repaired_by_force(rows, spare=3):
    """Cost, audit and texts by trying every edit of every row and up to ``spare`` insertions anywhere."""
    best = None

    def walk(k, state, cost, audit, texts, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(rows) and state in (0, 3) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, list(texts))
        for letter, name in (("u", "user"), ("a", "assistant")):
            to = {(0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, letter))
            if to is not None and inserts < spare:
                walk(k, to, cost + 3, audit + "I", [*texts, f"{name}:"], inserts + 1)
        if k == len(rows):
            return
        initial, fault, role, text = rows[k]
        walk(k + 1, state, cost + 4, audit + "D", texts, 0)
        if fault in ("blank", "duplicate"):
            return
        more = 3 if fault == "truncated" else 0
        to = conversations.NEXT.get((state, initial))
        if to is not None:
            walk(k + 1, to, cost + more, audit + "K", [*texts, f"{role}:{text}"], 0)
        for letter, name in (("u", "user"), ("a", "assistant")):
            to = conversations.NEXT.get((state, letter))
            if to is not None:
                walk(k + 1, to, cost + 3 + more, audit + "R", [*texts, f"{name}:{text}"], 0)

    walk(0, 0, 0, "", [], 0)
    return best


def test_search_against_all_edits():
    symbols = [(i, f) for i in "suat" for f in ("", "truncated")] + [("u", "blank"), ("a", "duplicate"), ("", "")]
    rng = random.Random(7)
    cases = [rows for n in range(3) for rows in itertools.product(symbols, repeat=n)]
    cases += [tuple(rng.choice(symbols) for _ in range(rng.randint(3, 6))) for _ in range(200)]
    for rows in cases:
        expected = repaired_by_force([(i, f, i, "x") for i, f in rows])
        assert conversations.search(rows, 0, (0, 3)) == expected[:2], rows


def test_blocks_combine_to_the_whole(monkeypatch):
    rng = random.Random(8)
    for size in (1, 2, 5):
        monkeypatch.setattr(conversations, "BLOCK", size)
        for _ in range(60):
            rows = tuple((rng.choice("suat"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(1, 14)))
            walk = conversations._Walk({}, True)
            for row in rows:
                walk.add(*row)
            assert walk.best() == conversations.search(rows, 0, (0, 3))


def expected_repairs(rows, ids):
    out = {}
    for conv in ids:
        own = [(t, r, x) for c, t, r, x in rows if c == conv]
        marked = faulty_rows(own)
        turns = {t for t, _, _ in own if t is not None}
        initials = [m[0] for m in marked]
        cost, audit, texts = repaired_by_force(marked)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(m[1] == f for m in marked) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha("\n".join(texts)),
        )
    return out


def odd_conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        turn = rng.randint(-3, 5)
        for _ in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", " "])
            text = rng.choice(["Yes.", "No!", "so", " ", "", "Why? ", f"{rng.random()}.", "é。", "x.\x0b"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text))
            turn += rng.choice([0, 1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("parts", [1, 16])
def test_repairs_against_all_edits_whole_and_cut(spark, parts):
    """With sixteen ranges most conversations are cut, and are put together from pieces."""
    rows = odd_conversations(parts)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = talk(spark, rows)
        found = conversations.repair(made, made.select("conv_id").union(spark.sql("select 777L"))).collect()
        turns = conversations.repaired_turns(made).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ids = {r[0] for r in rows}
    expected = expected_repairs(rows, ids) | {777: (0, 0, 0, 0, 0, 0, "", sha(""))}
    assert len(found) == len(expected)
    for r in found:
        assert tuple(r)[1:] == expected[r.conv_id], r
        texts = [f"{t.role}:{t.text}" for t in sorted((t for t in turns if t.conv_id == (None if r.conv_id is None else str(r.conv_id))), key=lambda t: t.place)]
        assert sha("\n".join(texts)) == r.repaired_sha256


def test_a_long_conversation_spans_tasks(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant"]), f"t{k}" + rng.choice(["", ".", "!"])) for k in range(900)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: r for r in conversations.repair(talk(spark, rows), talk(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    marked = tuple(m[:2] for m in faulty_rows([r[1:] for r in rows if r[0] == 1]))
    assert (found[1].cost, found[1].audit) == conversations.search(marked, 0, (0, 3))
    assert (found[2].cost, found[2].audit) == (0, "KK")


def test_damage_and_conversations_without_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 < 5]
    rows = [(i, 0, "assistant", "One. Two!") for i in ids] + [(None, None, None, None)]
    made = damaged(talk(spark, rows)).collect()
    fates = {i: zlib.crc32(f"{i}:0".encode()) % 20 for i in ids}
    by_id = {r.conv_id: r for r in made}
    assert {i for i in ids if fates[i] == 0}.isdisjoint(by_id)
    for i, fate in fates.items():
        if fate:
            r = by_id[i]
            assert (r.text, r.copies, r.role) == (
                {1: "", 2: "One Two"}.get(fate, "One. Two!"), 2 if fate == 3 else 1, "user" if fate == 4 else "assistant")
    assert zlib.crc32(b" : ") % 20 > 4 and (by_id[None].role, by_id[None].text) == (" ", " ")
    found = {r.conv_id: r for r in conversations.repair(damaged(talk(spark, rows)), talk(spark, rows)).collect()}
    gone = next(i for i in ids if fates[i] == 0)
    assert tuple(found[gone])[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
    nothing = talk(spark, rows).filter("false")
    assert conversations.repair(damaged(nothing), nothing).collect() == [] and conversations.repaired_turns(damaged(nothing)).collect() == []


# -------------------------------------------------------------- variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def test_composition_against_all_pairs():
    rng = random.Random(10)
    for _ in range(40):
        words = {"".join(rng.choices("abé", k=rng.randint(0, 6))) for _ in range(rng.randint(1, 60))}
        found = list(variants.one_edit_pairs(list(words)))
        assert len(found) == len(set(found)) == len({frozenset(p) for p in found})
        assert {frozenset(p) for p in found} == {frozenset(p) for p in itertools.combinations(words, 2) if one_edit(*p)}


def test_the_acceptor_is_minimal_and_exact():
    words = sorted({"".join(w) for n in range(4) for w in itertools.product("ab", repeat=n)} | {"abbaab"})
    edges, final, start = variants.minimised(words)
    reached, stack, accepted = {start}, [(start, "")], []
    while stack:
        state, read = stack.pop()
        if final[state]:
            accepted.append(read)
        for letter, to in edges[state].items():
            reached.add(to)
            stack.append((to, read + letter))
    assert sorted(accepted) == words
    forms = [(final[s], tuple(sorted(edges[s].items()))) for s in reached]
    assert len(forms) == len(set(forms))


def variants_by_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def spelling_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéÿÀX", k=rng.randint(5, 12))) for _ in range(40)]
    base += [b[:k] + rng.choice(["", "a", "é", "zz"]) + b[k + 1 :] for b in base for k in range(0, len(b), 2)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choice(base[: rng.choice([5, 40, len(base)])]) + rng.choice(["", ".", "9", "÷"]) for _ in range(120))))
    return rows + [(None, rows[0][1]), (3, None), (4, ""), (5, "x" * 5000 + " " + ("y" * 5001 + " ") * 6), rows[7]]


@pytest.mark.parametrize("most", [variants.MOST, 3])
def test_variants_against_all_pairs_whole_and_dealt_again(spark, most):
    """Partitions of over three words are dealt again until one code point is left."""
    rows = spelling_rows(most)
    found = variants.variants(frame(spark, rows), most).collect()
    assert sorted((tuple(r) for r in found), key=lambda r: r[0]) == sorted(variants_by_force(rows), key=lambda r: r[0])
    assert any(r.root != r.form for r in found if r.form) or any(r.form for r in found)


def test_forms_lead_on_to_the_last(spark):
    chain = [(f"{i:03}", f"{i + 1:03}") for i in range(40)]
    found = variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.root for r in found} == {"040"} and len(found) == 40


def test_numerals_are_no_letters():
    from hardwood.llm.subwords import letters

    assert letters("½ ² ³ ① Ⅷ") == [] and letters("a½b Éx²") == ["a", "b", "éx"] and letters("ab 1c_d") == ["ab", "c", "d"] and letters(None) == []


def test_mixing_moves_no_text(spark, monkeypatch):
    """Documents are repeated in the pass that classifies them: no exchange and no join, whatever their number."""
    from hardwood.llm import mixing

    docs = frame(spark, [(i, "the cat and the dog" if i % 2 else "der hund und die katze") for i in range(40)])
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de").alias("label"))
    stored = common.staged(docs, "docs")
    plan = mixing.mixed(stored, labels, {"en": 0.8, "de": 0.2}, least=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "MapInArrow" in plan


def test_empty_tables_keep_their_columns(spark):
    nothing = frame(spark, [(1, "a")]).filter("false")
    assert substrings.without_repeats(nothing).collect() == [] and variants.variants(nothing).collect() == []
    assert substrings.without_repeats(nothing).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert variants.variants(nothing).columns == ["word", "form", "root", "n", "n_near", "form_n"]
