r"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

* **Base spans.** Email addresses, IPv4 addresses, card numbers and phone numbers: the leftmost non-overlapping matches
  of one pattern a kind; a match that fails its kind's check (parts at most 255, 14 to 19 digits passing Luhn, 10 to 15
  digits) is no base span. Base spans are always returned.
* **Candidates.** Besides all matches, failed ones too: digit groups inside failed card matches, international numbers
  inside failed phone matches, national phone numbers without ``+``, and spelled-out addresses (``name [at] host``).
* **Labelers** vote for (1), against (-1) or not at all (0): ``form`` (the strict pattern and check sums), ``gazetteer``
  (top-level domains, special address ranges, issuer prefixes, calling codes), ``cue`` (words up to 40 characters before
  or 20 behind) and ``company`` (other base spans in the text).
* **Expectation-maximisation** (Dawid and Skene's model, kind by kind; a labeler that does not vote says nothing) over
  the counts of vote patterns gives each labeler's reliability and each pattern's probability, without any label.
* **Classifier.** Naive Bayes over the kind, the votes and the span's shape (separators, length, what stands before it),
  trained on all candidates weighted by those probabilities. A candidate that passes its kind's check and scores
  ``threshold`` or more is added to the base spans.

Texts are read once; a row carries its spans in arrays, so nothing is joined or exchanged but the counts of patterns:
their number is bounded by the values of votes and shapes (``4 * 3^4 * 5 * 4 * 3``), whatever the table's size, and the
fit runs on them alone. DataFrame functions only. Patterns are possessive and anchored at the start of their runs, so
long runs of letters or digits cost linear time; offsets are running sums of the lengths between matches.

Defined results: null and empty texts have no span; a null id keeps its row; repeated rows are reported each; an empty
table gives an empty result; a very long text costs time in proportion to its length; other columns are ignored. Offsets
count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import computed, pinned

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("form", "gazetteer", "cue", "company")
SHAPES = ("separator", "length", "before")
THRESHOLD = 0.5
ROUNDS = 50
CHUNK = 256

LOCAL = "[A-Za-z0-9._%+-]"
#: (kind, pattern, whether its checked matches are base spans, strings of which a text with a match holds one)
PATTERNS = (
    (EMAIL, rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, ("@",)),
    (IP, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", True, (".",)),
    (CARD, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+", True, ("",)),
    (PHONE, r"\+[0-9][ ().0-9-]+[0-9]", True, ("+",)),
    (EMAIL, rf"(?<!{LOCAL}){LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++", False, ("at]", "at)")),
    (PHONE, r"(?=[(0-9])(?<![+0-9][ .(-]{0,2})(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", False, ("",)),
)
#: What is looked for inside a failed match of a kind.
RETRIES = {
    CARD: r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{2,4})(?![0-9])",
    PHONE: r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}

# Public lists of top-level domains, issuer prefixes, calling codes and cue words.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|eu|uk|de|fr|es|it|nl|pl|ru|cn|jp|in|br|ca|au|ch|at|se|no|dk|fi|pt|mx|us"
SPECIAL_IP = r"^0*(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0245])"
CALLING = (r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|2[2-6][0-9]|29[0179]|35[0-9]|37[0-9]|38[0-9]"
           r"|42[013]|50[0-9]|59[0-9]|67[0-9]|68[0-9]|69[0-2]|85[0-6]|88[068]|96[0-8]|97[0-9]|99[2-8])")
CUES = {EMAIL: "mail|contact|write|address", IP: "host|server|login|client|address|ip", CARD: "card|visa|master|pay|debit|credit",
        PHONE: "phone|tel|call|mobile|fax|ring|dial"}
AGAINST = "version|release|isbn|issn|order|invoice|serial|sku|token|hash|build|commit|page"


def _octets() -> str:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return rf"^{part}(?:\.{part}){{3}}$"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def is_valid(kind: Column, value: Column) -> Column:
    """Whether a match passes its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (F.when(kind == EMAIL, F.lit(True))
             .when(kind == IP, value.rlike(_octets()))
             .when(kind == CARD, F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False))
             .otherwise(F.length(digits).between(10, 15)))


def running_sums(df: DataFrame, sizes: str, out: str) -> DataFrame:
    """``df`` with ``out``, the running sums of each array in the array of arrays ``sizes``.

    Sums run over chunks first and inside each chunk then: an array that grows by one element is copied each time.
    """
    names = [F.col(c) for c in df.columns]
    chunked = F.transform(sizes, lambda a: F.transform(
        F.sequence(F.lit(0), ((F.size(a) - 1) / CHUNK).cast("int")), lambda c: F.slice(a, c * CHUNK + 1, F.lit(CHUNK))))
    df = computed(df, *names, chunked.alias("_chunks"))

    def grow(a: Column, x: Column) -> Column:
        return F.concat(a, F.array(F.element_at(a, -1) + x))

    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    offsets = F.transform("_chunks", lambda cs: F.aggregate(F.transform(cs, total), F.array(F.lit(0)), grow))
    df = computed(df, *names, F.arrays_zip(F.col("_chunks"), offsets.alias("_offsets")).alias("_both"))
    sums = F.transform("_both", lambda b: F.flatten(F.transform(b["_chunks"], lambda c, j: F.slice(
        F.aggregate(c, F.array(F.get(b["_offsets"], j)), grow), F.lit(2), F.size(c)))))
    return computed(df, *names, sums.alias(out))


def _located(df: DataFrame, keep: list[str], texts: str) -> DataFrame:
    """``df(keep)`` with ``found``, an array for each of ``texts`` (an array of ``(gaps, matches)``).

    A match comes with its start, value, and the end and the beginning of what stands around it.
    """
    sizes = F.transform(texts, lambda g: F.transform(g["matches"], lambda m, i: F.length(F.get(g["gaps"], i)) + F.length(m)))
    df = computed(df, *dict.fromkeys([*keep, texts]), sizes.alias("_sizes"))
    df = running_sums(df, "_sizes", "_ends")
    both = F.arrays_zip(F.col(texts).alias("g"), F.col("_ends").alias("ends"))
    found = F.transform(both, lambda b: F.transform(b["g"]["matches"], lambda m, i: F.struct(
        (F.get(b["ends"], i) - F.length(m)).alias("start"), m.alias("value"),
        F.right(F.get(b["g"]["gaps"], i), F.lit(40)).alias("before"),
        F.left(F.get(b["g"]["gaps"], i + 1), F.lit(20)).alias("after"))))
    return computed(df, *keep, found.alias("found"))


def _matched(text: Column, pattern: str, needs: tuple[str, ...]) -> Column:
    """What stands between the matches of ``pattern``: the whole text if there is none."""
    return F.when(reduce(lambda a, b: a | b, [text.contains(n) for n in needs]), F.split(text, pattern, -1)).otherwise(F.array(text))


def candidates(docs: DataFrame) -> DataFrame:
    """``(id, spans)`` of ``docs(id, text)``: each span with kind, start, end, whether valid and base, and its surroundings."""
    gaps = [_matched(F.col("text"), p, needs).alias(f"g{i}") for i, (_, p, _, needs) in enumerate(PATTERNS)]
    df = computed(docs.select("id", F.coalesce("text", F.lit("")).alias("text")), "id", "text", *gaps)
    none = F.array().cast("array<string>")
    groups = F.array(*[F.struct(
        F.when(F.size(f"g{i}") > 1, F.col(f"g{i}")).otherwise(none).alias("gaps"),
        F.when(F.size(f"g{i}") > 1, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias("matches"))
        for i, (_, p, _, _) in enumerate(PATTERNS)])
    df = _located(computed(df, "id", groups.alias("groups")), ["id"], "groups")

    def span(kind, base: bool):
        def of(m: Column) -> Column:
            k = F.lit(kind) if isinstance(kind, int) else kind
            return F.struct(k.alias("kind"), m["start"].alias("start"), m["value"].alias("value"), m["before"].alias("before"),
                            m["after"].alias("after"), F.lit(base).alias("base"))
        return of

    spans = F.concat(*[F.transform(F.get("found", F.lit(i)), span(kind, base)) for i, (kind, _, base, _) in enumerate(PATTERNS)])
    df = computed(df, "id", spans.alias("spans"))
    checked = F.transform("spans", lambda s: s.withField("valid", is_valid(s["kind"], s["value"])))
    df = computed(df, "id", checked.alias("spans"))

    # a second look into matches that failed
    def again(kind: int) -> Column:
        failed = F.filter("spans", lambda s: s["base"] & ~s["valid"] & (s["kind"] == kind))
        return F.transform(failed, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("from"), s["before"].alias("before"), s["after"].alias("after"),
            F.split(s["value"], RETRIES[kind], -1).alias("gaps"),
            F.regexp_extract_all(s["value"], F.lit(RETRIES[kind]), F.lit(0)).alias("matches")))

    df = computed(df, "id", "spans", F.filter(F.concat(*[again(k) for k in RETRIES]), lambda g: F.size(g["matches"]) > 0).alias("failed"))
    df = _located(df, ["id", "spans", "failed"], "failed")
    retried = F.flatten(F.transform(F.arrays_zip(F.col("failed").alias("f"), F.col("found").alias("found")), lambda b: F.transform(
        b["found"], lambda m: F.struct(
            b["f"]["kind"].alias("kind"), (b["f"]["from"] + m["start"]).alias("start"), m["value"].alias("value"),
            F.right(F.concat(b["f"]["before"], m["before"]), F.lit(40)).alias("before"),
            F.left(F.concat(m["after"], b["f"]["after"]), F.lit(20)).alias("after"), F.lit(False).alias("base"),
            is_valid(b["f"]["kind"], m["value"]).alias("valid")))))
    return computed(df, "id", F.concat("spans", retried).alias("spans"))


def _votes(s: Column, company: Column) -> Column:
    """A candidate reduced to its place, its votes and its shape."""
    kind, value, bare = s["kind"], s["value"], F.regexp_replace(s["value"], "[^0-9]", "")
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    strict = (F.when(kind == EMAIL, value.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@.*\.[A-Za-z]{2,24}$"))
               .when(kind == IP, ~value.rlike(r"(?:^|\.)0[0-9]"))
               .when(kind == CARD, F.lit(True)).otherwise(value.startswith("+")))
    form = F.when(~s["valid"], no).when(strict, yes).otherwise(none)
    listed = (F.when(kind == EMAIL, F.when(F.lower(value).rlike(rf"(?:\.|dot[\])]) ?(?:{DOMAINS})$"), yes).otherwise(none))
               .when(kind == IP, F.when(value.rlike(SPECIAL_IP), no).otherwise(none))
               .when(kind == CARD, F.when(bare.rlike(ISSUERS), yes).otherwise(none))
               .otherwise(F.when(value.rlike(CALLING), yes).when(value.startswith("+"), no).otherwise(none)))
    around = F.lower(F.concat(s["before"], F.lit(" "), s["after"]))
    named = reduce(lambda a, k: a.when(kind == k, around.rlike(rf"\b(?:{CUES[k]})")), list(CUES)[1:], F.when(
        kind == EMAIL, around.rlike(rf"\b(?:{CUES[EMAIL]})")))
    cue = F.when(around.rlike(rf"\b(?:{AGAINST})\b"), no).when(named, yes).otherwise(none)
    separator = (F.when(value.contains("("), 4).when(value.contains("-"), 3).when(value.contains("."), 2)
                  .when(value.contains(" "), 1).otherwise(0))
    long = F.length(value)
    return F.struct(kind.alias("kind"), s["start"].alias("start"), (s["start"] + long).alias("end"), s["base"].alias("base"),
                    s["valid"].alias("valid"), form.alias("form"), listed.alias("gazetteer"), cue.alias("cue"),
                    F.when(company > F.when(s["base"] & s["valid"], 1).otherwise(0), yes).otherwise(no).alias("company"),
                    separator.alias("separator"),
                    F.when(long < 12, 0).when(long < 16, 1).when(long < 24, 2).otherwise(3).alias("length"),
                    F.when(s["before"].rlike(r"[ \n\t]$"), 1).when(s["before"] == "", 0).otherwise(2).alias("before"))


def voted(docs: DataFrame) -> DataFrame:
    """``(id, spans)``: every candidate of ``docs(id, text)`` with its votes and shape, without its text."""
    df = candidates(docs)
    df = computed(df, "id", "spans", F.size(F.filter("spans", lambda s: s["base"] & s["valid"])).alias("company"))
    return df.select("id", F.transform("spans", lambda s: _votes(s, F.col("company"))).alias("spans"))


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, tuple[int, ...]], float]:
    """The probability of personal data for each ``(kind, votes)``, by expectation-maximisation over their counts.

    For each kind, a labeler that votes has a probability of being right for either truth; not voting says nothing. A
    kind has its share of true candidates. The first guess is the sum of the votes, the form's vote counted twice.
    """
    p = {}
    for kind in {k for k, _, _ in patterns}:
        own = [(v, n) for k, v, n in patterns if k == kind]
        q = {v: 1 / (1 + math.exp(-sum(v) - v[0])) for v, _ in own}
        total = sum(n for _, n in own)
        for _ in range(rounds):
            share = (1 + sum(n * q[v] for v, n in own)) / (2 + total)
            odds = {v: math.log(share / (1 - share)) for v, _ in own}
            for j in range(len(LABELERS)):
                true, false = {1: 2.0, -1: 1.0}, {1: 1.0, -1: 2.0}
                for v, n in own:
                    if v[j]:
                        true[v[j]] += n * q[v]
                        false[v[j]] += n * (1 - q[v])
                for v, _ in own:
                    if v[j]:
                        odds[v] += math.log(true[v[j]] / sum(true.values())) - math.log(false[v[j]] / sum(false.values()))
            q = {v: 1 / (1 + math.exp(min(700, max(-700, -odds[v])))) for v in odds}
        p |= {(kind, v): x for v, x in q.items()}
    return p


def train(rows: list[tuple[int, tuple[int, ...], tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, int, int], float]:
    """Log odds by (kind, feature, value); feature -1 is the kind itself. Rows: kind, votes, shape, count."""
    counts: dict[tuple[int, tuple[int, ...]], int] = {}
    for kind, votes, _, n in rows:
        counts[kind, votes] = counts.get((kind, votes), 0) + n
    p = reliabilities([(k, v, n) for (k, v), n in counts.items()], rounds)
    sums: dict[tuple[int, int, int], list[float]] = {}
    for kind, votes, shape, n in rows:
        true = n * p[kind, votes]
        for i, value in [(-1, 0), *enumerate(votes + shape)]:
            s = sums.setdefault((kind, i, value), [1.0, 1.0])
            s[0] += true
            s[1] += n - true
    odds = {}
    for (kind, i, value), s in sums.items():
        if i < 0 or i < len(LABELERS) and not value:
            odds[kind, i, value] = math.log(s[0] / s[1]) if i < 0 else 0.0
        else:
            among = [x for (k, j, v), x in sums.items() if (k, j) == (kind, i) and (v or j >= len(LABELERS))]
            odds[kind, i, value] = math.log(s[0] / sum(x[0] for x in among)) - math.log(s[1] / sum(x[1] for x in among))
    return odds


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, base, added)``: arrays of ``(start, kind, end, score)`` in order of start and kind (``KINDS``)."""
    df = pinned(voted(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), "personal-data")
    names = [*LABELERS, *SHAPES]
    rows = df.select(F.inline("spans")).groupBy("kind", *names).agg(F.count("*").alias("n")).collect()
    odds = train([(r["kind"], tuple(r[c] for c in LABELERS), tuple(r[c] for c in SHAPES), r["n"]) for r in rows])

    def code(kind: int, feature: int, value: int) -> int:
        return (kind * 10 + feature + 1) * 10 + value + 1

    cells = [F.lit(x) for (k, i, v), w in sorted(odds.items()) for x in (code(k, i, v), w)]
    table = F.create_map(*cells) if cells else F.create_map().cast("map<int,double>")

    def score(s: Column) -> Column:
        parts = [F.element_at(table, s["kind"] * 100 + 1)]
        parts += [F.element_at(table, s["kind"] * 100 + (i + 1) * 10 + s[c] + 1) for i, c in enumerate(names)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, parts)))

    scored = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), score(s).alias("score"),
        (s["base"] & s["valid"]).alias("is_base"), s["valid"].alias("valid")))
    df = computed(df, "id", scored.alias("spans"))
    slim = lambda s: F.struct(s["start"], s["kind"], s["end"], s["score"])
    base = F.transform(F.filter("spans", lambda s: s["is_base"]), slim)
    added = F.transform(F.filter("spans", lambda s: ~s["is_base"] & s["valid"] & (s["score"] >= threshold)), slim)
    return df.select(F.col("id").alias(id_col), F.array_sort(base).alias("base"), F.array_sort(added).alias("added"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, a digest of them, and all spans, of ``find_personal_data``'s result."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    both = F.array_sort(F.concat("base", "added"))
    return found.select(id_col, *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(both).alias("spans"))
