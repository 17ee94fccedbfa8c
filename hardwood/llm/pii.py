r"""Personal data: weak supervision over regex, gazetteer and context labelers.

Each whole text is read once. The base kinds (email, ip, card, phone) are found by fixed patterns and checks and
always stay. Wider patterns propose further candidates: numbers inside longer runs of digits, phone numbers as written within
the United States, France, Germany and Spain, account numbers, written-out addresses, keys. Five labelers vote on each candidate (1 for, -1 against, 0 abstains):
form (with the check digits of cards and accounts), gazetteer of issuers and prefixes, words before it, signs against, and variety of characters. Vote patterns are
counted by Spark (a bounded table: kinds times 3^5 times three lengths times two); on it, expectation-maximisation estimates, for each kind and
labeler, how often it votes for or against true and false candidates, and each pattern's probability. A labeler that votes alike on both, such as one that always says
yes, is no evidence; an abstention has no weight. Base spans vote too and count as true, so that a kind's labelers are known from these. What
check digits do is arithmetic and not estimated (``KNOWN``). A logistic span classifier
is trained on those soft labels. The classifier is applied as a DataFrame expression; candidates at 0.5 or more join
the base spans. Only DataFrame functions touch rows. The words before a span are looked up in the last ``CONTEXT_CHARS`` characters
before it, not beyond the span before.

Patterns are possessive and anchored at the start of a run, so that they take time in proportion to the text; what they
match is the same as for the plain forms. Positions count code points; a match's start is the total length of what lies
before it between and in matches.

Defined results: a null or empty text has no spans; a candidate that overlaps a base span is dropped; without candidates no classifier is trained; repeated rows are each returned; an empty table gives
an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import staged

BASE_KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: Kind: pattern, and a character that a text needs to hold for it.
BASE = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", ""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: Kinds and patterns of further candidates.
WIDER = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[a-z0-9-]{1,63}+(?: ?(?:[\[(]dot[\])]|\.) ?[a-z]{2,24}){1,4}",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
    "phone": (
        r"(?<![0-9A-Za-z+(])(?:(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])|(?<![0-9][ .-])(?:0[1-9](?:[ .-]?[0-9]{2}){4}"
        r"|\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{3,5}[ -]?[0-9]{2,5}|[6-9][0-9]{2}(?:(?:[ .-][0-9]{3}){2}|(?:[ .-][0-9]{2}){3}))(?![ .-]?[0-9])(?![A-Za-z]))"
    ),
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{20,}+={0,2}",
}
KINDS = (*BASE_KINDS, *(k for k in WIDER if k not in BASE_KINDS))

# Fixed values of the labelers: patterns by kind, in Java's syntax, on the value or on the lower-cased text before it.
FORM = {
    "email": r"(?i)^[a-z0-9][a-z0-9._%+-]*(?:@| ?[\[(]at[\])])", "card": r"^[0-9 -]+$", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "phone": r"^(?:\+[1-9]|\(?[2-9][0-9]{2}\)?[ .-]*[2-9][0-9]{2}[ .-][0-9]{4}$|0[1-9]([ .-]?)[0-9]{2}(?:\1[0-9]{2}){3}$|\(?0[1-9][0-9]{1,3}\)?[ /-][0-9 -]+$|[6-9][0-9]{2}([ .-])[0-9]{2,3}\2[0-9]{2,3}(?:\2[0-9]{2})?$)",
    "iban": r"^[A-Z]{2}(?!00|01|99)[0-9]{2}", "secret": r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_/+-]+={0,2}$",
}
# Cards: issuer with its lengths. Phones: country codes, area codes of large American cities, French zones, German mobile and city
# codes, Spanish mobile and province codes. Social security numbers: areas given out before 2011.
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|de|fr|es|io)$", "card": r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|35[0-9]{14}|6[0-9]{15,18})$",
    "phone": (
        r"^(?:\+(?:1|30|31|32|33|34|39|41|43|44|45|46|47|48|49|351|353|358|420)|\(?(?:201|202|206|212|213|214|215|216|301|303|305|310|312|313|314|404|408|412|415|503|512|602|610|617|619|702|703|713|714|718|773|786|808|818|832|917|949|972)"
        r"|0[1-79](?=(?:[ .-]?[0-9]{2}){4}$)|\(?0(?:1[567][0-9]|30|40|69|89|201|211|221|231|341|351|421|511|711|911)|(?:6[0-9]|7[1-4]|91|93|95|96|98))"
    ),
    "ssn": r"^(?:0[0-9]{2}|[1-6][0-9]{2}|7[0-6][0-9]|77[0-2])",
    "iban": r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)", "secret": r"^(?:sk-|pk-|ghp_|gho_|github_pat_|AKIA|ASIA|xox[abp]-|AIza|eyJ|[0-9a-fA-F]{32,}$)",
}
#: Kinds whose gazetteer is complete: what it doesn't list is voted against.
CLOSED = ("card", "ssn")
CONTEXT = {
    "email": r"mail|contact|write|schreib|courriel|correo", "card": r"card|visa|master|amex|credit|kredit|carte|tarjeta", "phone": r"tel|phone|call|mobil|cell|fax|anruf|appel|llam",
    "ssn": r"ssn|social", "iban": r"iban|account|konto|compte|cuenta|bank", "secret": r"token|secret|key|password|passwd|pwd|auth|bearer|credential",
}
AGAINST = r"(?:[$€£%#]|isbn|issn|doi|version|order|sha256|sha1|md5|commit|checksum)[\s:=]*$"
CONTEXT_CHARS = 24
LABELERS = ("form", "gazetteer", "context", "against", "variety")
ROUNDS, START = 60, 0.8
#: First rates of voting for, abstaining and voting against a true candidate; for a false one the other way round. They go on counting as ``WEIGHT`` candidates.
FIRST, WEIGHT = {1: 0.6, 0: 0.25, -1: 0.15}, 4
#: True candidates among ``SHARE[1]`` imagined ones of each kind: below one half, so that a kind without evidence is rejected.
SHARE = (1, 4)
#: Votes for true and false candidates by arithmetic: check digits hold in nearly all true numbers, and by chance in one of ten, or one of 97.
KNOWN = {("card", "form"): (0.99, 0.1), ("iban", "form"): (0.99, 0.01)}


def located(text: Column, pattern: str) -> Column:
    """Array of (start, stop, value, before) of the leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(between, found, lambda b, f: F.struct(b.alias("b"), f.alias("f")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,value:string,before:string>>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        stop = start + F.length(x["f"])
        span = F.struct(start.alias("start"), stop.alias("stop"), x["f"].alias("value"), F.right(x["b"], F.lit(CONTEXT_CHARS)).alias("before"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, none, add, lambda acc: acc["spans"])


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", F.when(F.length(digits).between(13, 19), digits).otherwise(F.lit("0")))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _passing(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


_NO_SPANS = "array<struct<start:int,stop:int,value:string,before:string>>"


def _spelled(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string")))


def _rest97(bare: Column) -> Column:
    """An account number's rest by 97, its first four characters moved to the end and letters read as 10 to 35."""
    moved = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(moved, F.lit(0), add)


def _vote(kind: str, s: Column) -> list[Column]:
    """Votes of the labelers on one candidate."""
    value, before = s["value"], F.lower(s["before"])
    bare = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    variety = F.size(F.array_distinct(F.split(bare, "")))
    digits = F.regexp_replace(value, "[^0-9]", "")
    form = value.rlike(FORM[kind])
    if kind == "card":
        form = F.call_function("luhn_check", digits)
    if kind == "iban":
        form = form & (_rest97(bare) == 1)
    listed = (digits if kind == "card" else value).rlike(GAZETTEER[kind])
    against = before.rlike(AGAINST)
    return [
        F.when(form, 1).otherwise(-1), F.when(listed, 1).otherwise(-1 if kind in CLOSED else 0), F.when(before.rlike(CONTEXT[kind]), 1).otherwise(0),
        F.when(against, -1).otherwise(0), F.when(variety >= 5, 1).when(variety <= 2, -1).otherwise(0),
    ]


def read(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base (array of spelled spans per kind) and candidates of every row; one pass, no shuffle."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), text.rlike("[0-9]").alias("digit"))
    empty = F.array().cast(_NO_SPANS)
    found = {}
    for kind, (pattern, needs) in BASE.items():
        there = F.contains("text", F.lit(needs)) if needs else F.lit(True)
        if kind != "email":
            there = F.col("digit") & there
        found[f"b_{kind}"] = F.when(there, _passing(kind, located(F.col("text"), pattern))).otherwise(empty)
    for kind, pattern in WIDER.items():
        there = F.col("digit") if kind != "email" else F.col("text").rlike(r"(?i)[\[(]at[\])]")
        found[f"w_{kind}"] = F.when(there, located(F.col("text"), pattern)).otherwise(empty)
    spans = rows.select("doc_id", *[c.alias(n) for n, c in found.items()])
    base = F.concat(*[F.col(f"b_{k}") for k in BASE_KINDS])
    with_base = spans.withColumn("base", base)

    def told(kind: str, s: Column) -> list[Column]:
        length = F.least(F.greatest(F.length(s["value"]) - 12, F.lit(0)) / 12, F.lit(2)).cast("int")
        return [F.lit(KINDS.index(kind)).alias("kind"), F.array(*_vote(kind, s)).alias("votes"), length.alias("length")]

    def candidates(kind: str) -> Column:
        free = F.filter(f"w_{kind}", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
        return F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), *told(kind, s)))

    def sure(kind: str) -> Column:
        return F.transform(f"b_{kind}", lambda s: F.struct(*told(kind, s)))

    return with_base.select(
        "doc_id", *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        *[_spelled(F.col(f"b_{k}"), k).alias(f"s_{k}") for k in BASE_KINDS], F.concat(*[candidates(k) for k in WIDER]).alias("candidates"),
        F.concat(*[sure(k) for k in BASE_KINDS if k in WIDER]).alias("anchors"),
    )


def estimate(patterns: Iterable[tuple[int, tuple[int, ...], float]], anchors: Iterable[tuple[int, tuple[int, ...], float]] = ()) -> tuple[dict, dict, dict]:
    """Expectation-maximisation over (kind, votes, count): shares of true candidates by kind; rates, the probability of vote v of labeler
    j on true and on false candidates, by (kind, j, v, truth); and the probability of each (kind, votes). ``anchors`` are known to be true."""
    rows, sure = list(patterns), list(anchors)
    kinds = sorted({k for k, _, _ in rows})
    share = dict.fromkeys(kinds, SHARE[0] / SHARE[1])
    rates = {(k, j, v, t): FIRST[v if t else -v] for k in kinds for j in range(len(LABELERS)) for v in FIRST for t in (True, False)}
    belief: dict = {}
    for _ in range(ROUNDS):
        belief = {}
        for kind, votes, _ in rows:
            odds = math.log(share[kind] / (1 - share[kind]))
            odds += sum(math.log(rates[kind, j, v, True] / rates[kind, j, v, False]) for j, v in enumerate(votes) if v)
            belief[kind, votes] = 1 / (1 + math.exp(-min(max(odds, -500), 500)))
        for kind in kinds:
            own = [(v, n, belief[kind, v]) for k, v, n in rows if k == kind]
            share[kind] = (SHARE[0] + sum(n * b for _, n, b in own)) / (SHARE[1] + sum(n for _, n, _ in own))
            own += [(v, n, 1.0) for k, v, n in sure if k == kind]
            for truth in (True, False):
                weights = [(v, n * (b if truth else 1 - b)) for v, n, b in own]
                total = WEIGHT + sum(w for _, w in weights)
                for j, name in enumerate(LABELERS):
                    for v, first in FIRST.items():
                        before = first if truth else FIRST[-v]
                        rates[kind, j, v, truth] = (WEIGHT * before + sum(w for votes, w in weights if votes[j] == v)) / total
                    if (known := KNOWN.get((KINDS[kind], name))) is not None:
                        for_it = known[0] if truth else known[1]
                        rates[kind, j, 1, truth], rates[kind, j, -1, truth] = for_it, 1 - for_it
    return share, rates, belief


def reliabilities(
    patterns: Iterable[tuple[int, tuple[int, ...], float]], anchors: Iterable[tuple[int, tuple[int, ...], float]] = ()
) -> tuple[dict[int, float], list[float], dict]:
    """Shares of true candidates by kind, how often each labeler's votes are right over all kinds (``START`` for one that never voted), and the
    probability of each (kind, votes)."""
    rows = list(patterns)
    share, _, belief = estimate(rows, anchors)
    right = []
    for j in range(len(LABELERS)):
        good = sum(n * (belief[k, v] if v[j] > 0 else 1 - belief[k, v]) for k, v, n in rows if v[j])
        right.append((WEIGHT * START + good) / (WEIGHT + sum(n for _, v, n in rows if v[j])))
    return share, right, belief


def train_spans(counted: list[tuple[int, tuple[int, ...], int, float, float]], steps: int = 400, rate: float = 1.0, penalty: float = 1e-3) -> dict:
    """Logistic weights of ('kind', k), ('vote', k, j, v) and ('length', n) by gradient descent on soft labels, rows weighted by the logarithm of their count."""
    weights: dict = {}
    rows = []
    for kind, votes, length, n, wanted in counted:
        names = [("kind", kind), *(("vote", kind, j, v) for j, v in enumerate(votes) if v), ("length", length)]
        rows.append((names, wanted, math.log1p(n)))
        weights.update(dict.fromkeys(names, 0.0))
    total = sum(w for _, _, w in rows) or 1.0
    for _ in range(steps):
        back = {name: penalty * w for name, w in weights.items()}
        for names, wanted, w in rows:
            wrong = 1 / (1 + math.exp(-sum(weights[x] for x in names))) - wanted
            for x in names:
                back[x] += wrong * w / total
        weights = {name: w - rate * back[name] for name, w in weights.items()}
    return weights


def _margin(weights: dict, s: Column) -> Column:
    parts = [F.lit(0.0)]
    for name, w in sorted(weights.items(), key=str):
        if name[0] == "kind":
            parts.append(F.when(s["kind"] == name[1], F.lit(w)).otherwise(F.lit(0.0)))
        elif name[0] == "vote":
            voted = (s["kind"] == name[1]) & (F.get(s["votes"], F.lit(name[2])) == name[3])
            parts.append(F.when(voted, F.lit(w)).otherwise(F.lit(0.0)))
        else:
            parts.append(F.when(s["length"] == name[1], F.lit(w)).otherwise(F.lit(0.0)))
    return F.aggregate(F.array(*parts), F.lit(0.0), lambda a, b: a + b)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans and spans (spelled kind:start:end, by kind, then start) of every row."""
    rows = staged(read(docs), "spans")
    def counts(column: str) -> list[tuple[int, tuple[int, ...], int, int]]:
        table = rows.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes", "c.length").count()
        return sorted((r.kind, tuple(r.votes), r.length, r["count"]) for r in table.collect())

    def by_votes(counted: list[tuple]) -> list[tuple]:
        return [(k, v, sum(x[3] for x in of)) for (k, v), of in itertools.groupby(counted, key=lambda x: x[:2])]

    proposed, sure = counts("candidates"), counts("anchors")
    _, _, belief = estimate(by_votes(proposed), by_votes(sure))
    soft = [(*x, belief[x[:2]]) for x in proposed] + [(*x, 1.0) for x in sure]
    weights = train_spans(soft)
    accepted = F.filter("candidates", lambda s: _margin(weights, s) >= 0)

    def of_kind(kind: str) -> Column:
        added = F.transform(
            F.filter("accepted", lambda s: s["kind"] == KINDS.index(kind)),
            lambda s: F.struct(s["start"].alias("start"), F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string")).alias("text")),
        )
        if kind in BASE_KINDS:
            base = F.transform(f"s_{kind}", lambda t: F.struct(F.split_part(t, F.lit(":"), F.lit(2)).cast("int").alias("start"), t.alias("text")))
            added = F.concat(base, added)
        return F.transform(F.array_sort(added), lambda s: s["text"])

    return rows.withColumn("accepted", accepted).select(
        "doc_id", *[f"n_{k}" for k in BASE_KINDS], F.array_join(F.concat(*[F.col(f"s_{k}") for k in BASE_KINDS]), ",").alias("base_spans"),
        F.array_join(F.concat(*[of_kind(k) for k in KINDS]), ",").alias("spans"),
    )
