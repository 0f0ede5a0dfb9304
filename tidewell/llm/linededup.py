r"""Line deduplication by winnowing over line hashes.

A text is cut into line units: physical lines, cut again after each sentence
and after ``unit_words`` words, so that a passage is found wherever it begins.
Units keep their trailing space; all units together are the text. A unit's
hash is that of its trimmed content.

* A shingle is ``shingle_units`` consecutive units, or as many more as it takes
  to reach ``min_chars`` characters together: short sentences, short lines and
  single shouted words have shingles too. Where it ends depends on the text
  behind its start only; its hash is taken over its units' hashes.
* Winnowing keeps, in every window of ``window`` consecutive shingles of a
  document, the smallest hash (the leftmost of equals). Two copies of a run
  that holds ``window`` shingles therefore keep the same fingerprint. With the
  defaults that is every run of over 50 words of 2.6 letters or more on
  average. Shorter runs that hold no fingerprint are left alone.
* A whole line of ``min_chars`` characters or more is a fingerprint as well,
  however few its units.
* Fingerprints that come at more than one position are joined to their
  positions: the first in the order (id, text hash, unit) stays, the units of
  all later ones are deleted. At the ends of a deleted stretch the shingle is
  extended unit by unit as far as the run can go without another fingerprint:
  to the left by ``window`` units, to the right to the end of the shingle that
  starts where this one ends (of a later one in a wide window), or of the text.
  Each place is extended as far as any earlier place of the same shingle goes
  on alike, not the first alone: ``_reaches`` finds that by the beginnings of a
  few units and then by halves, so a copy costs some rows, whatever its length.
  Documents are numbered in that order first, so that a position is a single
  number (``numbered``). Only the least position of
  a group is ever aggregated, so a passage in a third of all documents costs
  no more than its rows.

DataFrame functions only. Texts are read once for the units and once when the
deleted units are cut out; everything between is hashes.

Defined results: null and empty texts and texts of white space come back as
they are, with no unit removed. A null id comes before all others. Rows with
equal id and text count as one document: they are treated alike, so none of
them loses a run to its own repetition. Repeats inside one document are later
runs too. Extra columns are kept; input columns called ``removed_units`` or
``removed_chars`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import computed, own_names, pinned

UNIT_WORDS = 10
SHINGLE_UNITS = 3
MIN_CHARS = 80
WINDOW = 2
SPACE = " \t\n\x0b\f\r"  # the pattern's white space
AT_ONCE = 8  # units of an extension that are compared by all their beginnings, not by halves
POS_BITS = 31  # a place is a document's number and, in its last bits, a unit's
STEPS = (1, 1, 1, 1, 6, 8)  # shingle sizes told apart by sums, in groups, before units are counted


def unit_pattern(unit_words: int = UNIT_WORDS) -> str:
    """Up to ``unit_words`` words; one that ends in ``. ! ?`` or before a line break is the last.

    Group 1 is the unit without the space around it. Possessive throughout: no backtracking.
    """
    return rf"\s*+((?:\S++(?<![.!?])[ \t]++(?=\S)){{0,{unit_words - 1}}}+\S++)\s*+"


def line_units(text: Column, unit_words: int = UNIT_WORDS, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(unit_pattern(unit_words)), F.lit(group))


def _is_picked(hashes: list[Column], few: Column) -> Column:
    """Whether the middle one of ``hashes`` (null: none) is the leftmost minimum of a window; ``few``: of all, fewer than a window."""
    window = len(hashes) // 2 + 1
    h = hashes[window - 1]
    left = [hashes[window - 1 - k] > h for k in range(1, window)]
    right = [hashes[window - 1 + k] >= h for k in range(1, window)]
    picked = few
    for test in left + right:
        picked = picked & F.coalesce(test, F.lit(True))
    for before in range(window):
        every = F.lit(True)
        for test in left[:before] + right[:window - 1 - before]:  # null beyond either end: no such window
            every = every & F.coalesce(test, F.lit(False))
        picked = picked | every
    return picked


def shingle_size(lengths: str, sums: str, i: Column, shingle_units: int, min_chars: int) -> Column:
    """Units of the shingle that starts at ``i``; null if the text ends before it does.

    ``sums`` holds the characters of ``shingle_units`` units from each one on (as many as there are).
    """
    def whole(a):
        return (a["n"] >= shingle_units) & (a["chars"] >= min_chars)

    def reached(n):  # units behind the end count nothing, so the least n that reaches min_chars ends in the text
        many = [F.get(sums, i + k) for k in range(0, n - shingle_units + 1, shingle_units)]
        one = [F.get(lengths, i + k) for k in range(len(many) * shingle_units, n)]
        return sum((F.coalesce(x, F.lit(0)) for x in [*many, *one][1:]), many[0]) >= min_chars

    # every unit has a character; an aggregate goes through all it is given, so it is left to what the sums don't settle
    ahead = F.slice(lengths, i + 1, F.lit(max(shingle_units, min_chars)))
    counted = F.aggregate(ahead, F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("chars")),
                          lambda a, x: F.when(whole(a), a).otherwise(
                              F.struct((a["n"] + 1).alias("n"), (a["chars"] + x).alias("chars"))),
                          lambda a: F.when(whole(a), a["n"]))
    size = F.when(i + shingle_units > F.size(lengths), F.lit(None).cast("int"))
    n = shingle_units
    for step in STEPS:
        last, among = n + step - 1, F.lit(n + step - 1)
        for k in range(last - 1, n - 1, -1):
            among = F.when(reached(k), F.lit(k)).otherwise(among)
        size = size.when(reached(last), among)
        n = last + 1
    return size.when(i + n > F.size(lengths), F.lit(None).cast("int")).otherwise(counted)


def unit_table(docs: DataFrame, unit_words: int, shingle_units: int, min_chars: int) -> DataFrame:
    """``(row, id, th, units, sizes, lines)`` of ``docs(id, text)``.

    ``units`` are the units' hashes, ``sizes`` the units of the shingle that starts at each, ``lines`` the first
    unit and the units of every line of ``min_chars`` characters. ``row`` numbers the rows; it is settled by writing
    the table.
    """
    # only the first unit can begin with space
    cut = computed(docs, "id", F.xxhash64("text").alias("th"), line_units(F.ltrim("text", F.lit(SPACE)), unit_words).alias("u"))
    ends = F.filter(F.transform("u", lambda x, i: F.when(x.contains("\n") | (i == F.size("u") - 1), i + 1)), lambda i: i.isNotNull())
    bare = F.transform("u", lambda x: F.rtrim(x, F.lit(SPACE)))
    bare = computed(cut, "id", "th", bare.alias("u"), ends.alias("ends"))
    sized = computed(bare, "id", "th", F.transform("u", lambda x: F.xxhash64(x)).alias("units"),
                     F.transform("u", lambda x: F.length(x)).alias("lengths"),
                     F.transform("ends", lambda e, j: F.struct(
                         F.coalesce(F.get("ends", j - 1), F.lit(0)).alias("pos"),
                         (e - F.coalesce(F.get("ends", j - 1), F.lit(0))).alias("n"))).alias("lines"))
    sums = F.col("lengths")
    for k in range(1, shingle_units):
        sums = F.zip_with(sums, F.slice("lengths", F.lit(k + 1), F.size("lengths")), lambda a, x: a + F.coalesce(x, F.lit(0)))
    summed = computed(sized, "id", "th", "units", "lengths", "lines", sums.alias("sums"))
    # most shingles and lines are long enough at once
    sizes = F.transform("sums", lambda s, i: F.when((s >= min_chars) & (i + shingle_units <= F.size("lengths")), shingle_units).otherwise(
        shingle_size("lengths", "sums", i, shingle_units, min_chars)))
    chars = lambda r: F.aggregate(F.slice("lengths", r["pos"] + 1, r["n"]), F.lit(0).cast("long"),
                                  lambda a, x: a + x)
    whole = lambda r: F.when((r["n"] >= shingle_units) & (F.get("sums", r["pos"]) >= min_chars), True).otherwise(
        chars(r) >= min_chars)
    return summed.select(F.monotonically_increasing_id().alias("row"), "id", "th", "units", sizes.alias("sizes"),
                         F.filter("lines", whole).alias("lines"))


def numbered(units: DataFrame) -> DataFrame:
    """``(doc, row, id, th, of)``: the documents that have units, ``of`` so many, numbered from 0 in the order (id, text hash).

    A document that comes in several rows has the least one. A place is a single number then, and the first of a group
    a plain minimum.
    """
    keys = units.filter(F.size("units") > 0).groupBy("id", "th").agg(F.min("row").alias("row"), F.max(F.size("units")).alias("of"))
    part = F.spark_partition_id()
    ranged = pinned(keys.repartitionByRange("id", "th").sortWithinPartitions("id", "th").select(
        part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("i"), "row", "id", "th", "of"), "order")
    counts = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, at = [], 0
    for p in range(max(counts, default=0) + 1):
        before.append(F.lit(at).cast("long"))
        at += counts.get(p, 0)
    return ranged.select((F.get(F.array(*before), F.col("part")) + F.col("i")).alias("doc"), "row", "id", "th", "of")


def fingerprints(units: DataFrame, shingle_units: int, window: int) -> DataFrame:
    """``(place, n, h)``: the shingles that winnowing keeps and the whole lines of ``units`` with ``doc``, by place and units."""
    def run(pos: Column, n: Column) -> Column:
        few = F.xxhash64(*[F.get("units", pos + k) for k in range(shingle_units)])  # the same hash, without a slice
        return F.when(n == shingle_units, few).when(n.isNotNull(), F.xxhash64(F.slice("units", pos + 1, n)))

    # null at the end, where no shingle begins
    keyed = computed(units, "doc", "sizes", F.transform("sizes", lambda n, i: run(i, n)).alias("hashes"), F.transform("lines", lambda r: F.struct(
        r["pos"].alias("pos"), r["n"].alias("n"), run(r["pos"], r["n"]).alias("h"))).alias("lines"))

    def picked(i: Column) -> Column:
        return _is_picked([F.get("hashes", i + k) for k in range(1 - window, window)], F.get("hashes", F.lit(window - 1)).isNull())

    # a line that is a kept shingle as well comes once
    lines = F.filter("lines", lambda r: ~(F.coalesce(F.get("sizes", r["pos"]) == r["n"], F.lit(False)) & picked(r["pos"])))
    keyed = computed(keyed, "doc", "sizes", "hashes", lines.alias("lines"))
    # a row for each shingle and line: plain columns, which Spark compiles, look into the text's arrays from there
    i, line = F.col("i"), F.get("lines", F.col("i") - F.size("hashes"))
    both = keyed.select("doc", "sizes", "hashes", "lines", F.posexplode(F.concat("hashes", "lines.h")).alias("i", "h"))
    return both.filter(F.col("h").isNotNull() & ((i >= F.size("hashes")) | picked(i))).select(
        (F.shiftleft("doc", POS_BITS) + F.coalesce(line["pos"], i)).alias("place"), F.coalesce(line["n"], F.get("sizes", i)).alias("n"), "h")


def _reaches(places: DataFrame) -> DataFrame:
    """``(place, run, far)``: how many units ``ext`` of a place has in common with an earlier place of the same ``run``.

    ``places(run, place, ext)``. Places that share nothing with an earlier one are left out. Of places with equal ``ext``
    all but the least go all the way; the least ones stand for them. Their first ``AT_ONCE`` units are compared at once, a row
    for each beginning. Behind them, among places that share these, the common length of those with all earlier ones is
    found by halves: of places with equal first halves of a segment all but the least go on in the second half only,
    beneath that group; the least one stands for them in the first half, and goes along in the second for the others to
    be compared with. A place costs a row or two a round, from the round of its own length on, and there is a round for
    each power of two.
    """
    whole = places.filter(F.size("ext") > 0).withColumn("whole", F.xxhash64("run", "ext"))
    # written, as in repeated_units; a later place needs its length only
    alike = pinned(whole.groupBy("whole").agg(F.min("place").alias("least")), "alike", "zstd")
    is_later = F.col("place") > F.col("least")
    settled = pinned(whole.join(alike.hint("shuffle_hash"), "whole").select(
        "place", "run", F.when(is_later, F.size("ext")).alias("far"), F.when(~is_later, F.col("ext")).alias("ext")), "settled", "zstd")
    far = settled.filter(F.col("far").isNotNull()).select("place", "run", "far")
    unlike = settled.filter(F.col("far").isNull()).select("run", "place", "ext")
    starts = unlike.select("place", "run", "ext", F.explode(F.sequence(F.lit(1), F.least(F.size("ext"), F.lit(AT_ONCE)))).alias("far")).select(
        "place", "run", "far", F.xxhash64("run", F.slice("ext", F.lit(1), F.col("far"))).alias("start"))
    least = pinned(starts.groupBy("start").agg(F.min("place").alias("least"), F.max("place").alias("last"))
                         .filter("least < last").select("start", "least"), "least", "zstd")
    far = far.unionByName(starts.join(least.hint("shuffle_hash"), "start").filter(F.col("place") > F.col("least")).select("place", "run", "far"))
    # those that share the first units and go on
    group = F.xxhash64("run", F.slice("ext", 1, AT_ONCE))
    fresh = pinned(unlike.filter(F.size("ext") > AT_ONCE).withColumn("group", group)
                         .join(least.select(F.col("start").alias("group")).hint("shuffle_hash"), "group", "left_semi")
                         .select("run", "place", F.slice("ext", F.lit(AT_ONCE + 1), F.size("ext")).alias("ext"), F.lit(AT_ONCE).alias("lo"), "group"),
                   "fresh", "zstd")
    longest = fresh.agg(F.max(F.size("ext"))).first()[0] or 0
    top = max(0, (longest - 1).bit_length())
    pieces = None
    for level in [*reversed(range(top)), None]:
        half = 1 << level if level is not None else 1  # the last round looks at single units
        if level is not None or top == 0:
            entering = F.size("ext") >= half
            if level is not None and level < top - 1:
                entering = entering & (F.size("ext") < 2 * half)
            pieces = fresh.filter(entering) if pieces is None else pieces.unionByName(fresh.filter(entering))
        keyed = pieces.filter(F.size("ext") >= half).withColumn("next", F.xxhash64("group", "lo", F.slice("ext", 1, half)))
        least = pinned(keyed.groupBy("next").agg(F.min("place").alias("least"), F.count("*").alias("times")).filter("times > 1")
                            .select("next", "least"), "least", "zstd")
        split = keyed.join(least, "next", "left").withColumn("later", F.coalesce(F.col("place") > F.col("least"), F.lit(False)))
        if level is None:
            shared = pinned(split.filter("later").select("place", "run", (F.col("lo") + 1).alias("far")), "shared", "zstd")
            return far.unionByName(shared).groupBy("place", "run").agg(F.max("far").alias("far"))
        # a piece carries the units of its own segment only
        rest = F.slice("ext", F.lit(half + 1), F.size("ext"))
        parts = F.array(
            F.when(F.col("least").isNotNull() & (F.size("ext") > half), F.struct(
                rest.alias("ext"), (F.col("lo") + half).alias("lo"), F.col("next").alias("group"), F.lit(False).alias("shared"))),
            F.when(~F.col("later"), F.struct(F.slice("ext", 1, half).alias("ext"), "lo", "group", F.lit(False).alias("shared"))),
            F.when(F.col("later"), F.struct(F.array().cast("array<bigint>").alias("ext"), (F.col("lo") + half).alias("lo"), "group",
                                            F.lit(True).alias("shared"))))
        short = pieces.filter(F.size("ext") < half).withColumn("shared", F.lit(False))
        both = pinned(short.unionByName(split.select("run", "place", F.inline(parts)).filter(
            F.col("group").isNotNull()).select(*short.columns)), "pieces", "zstd")
        shared = both.filter("shared").select("place", "run", F.col("lo").alias("far"))
        far = far.unionByName(shared)
        pieces = both.filter("not shared").drop("shared")


def repeated_units(docs: DataFrame, unit_words: int = UNIT_WORDS, shingle_units: int = SHINGLE_UNITS,
                   min_chars: int = MIN_CHARS, window: int = WINDOW) -> DataFrame:
    """``(id, th, of, gone)``: the runs ``(first, n)`` of units to delete, for documents that lose any, of their ``of`` units."""
    units = pinned(unit_table(docs, unit_words, shingle_units, min_chars), "units", "zstd")
    order = numbered(units)
    # nearly all rows of the job are prints
    prints = pinned(fingerprints(units.join(order.select("doc", "row"), "row"), shingle_units, window), "prints", "zstd")
    # written, so that the join is one of two plain tables: Spark splits a fingerprint of a third of all documents
    often = pinned(prints.groupBy("h").agg(F.min("place").alias("least"), F.max("place").alias("last"))
                         .filter("least < last").select("h", "least"), "often", "zstd")
    pos = F.col("place").bitwiseAND((1 << POS_BITS) - 1).cast("int")
    found = pinned(prints.join(often.hint("shuffle_hash"), "h")
                         .select("h", "place", "n", (F.col("place") > F.col("least")).alias("later")), "found", "zstd")
    later = found.filter("later").select("h", F.shiftright("place", POS_BITS).alias("doc"), pos.alias("pos"), "n")
    # a shingle is extended on a side where no other deleted one covers the next unit; all its copies are, to compare
    by_doc, end = Window.partitionBy("doc").orderBy("pos", "n"), F.col("pos") + F.col("n")
    open_left = F.coalesce((F.lag("pos").over(by_doc) == F.col("pos")) | (F.lag(end).over(by_doc) < F.col("pos")), F.lit(True))
    open_right = F.coalesce((F.lead("pos").over(by_doc) > end) | (F.lead(end).over(by_doc) <= end), F.lit(True))
    # shingles that touch or overlap are deleted as one stretch; its first and its last are open at its ends
    before = F.max(end).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    sided = later.select("h", "doc", "pos", "n", open_left.alias("left"), open_right.alias("right"), before.alias("before"))
    apart = F.coalesce((F.col("before") < F.col("pos")).cast("int"), F.lit(1))
    sided = pinned(sided.filter(F.col("left") | F.col("right")).select(
        "h", "doc", "pos", "left", "right", F.coalesce(F.greatest("before", end), end).alias("end"), F.sum(apart).over(by_doc).alias("stretch")),
        "sided", "zstd")
    edges = pinned(sided.groupBy("h").agg(F.max("left").alias("left"), F.max("right").alias("right")), "edges", "zstd")
    # a run that goes on beyond these bounds holds another fingerprint there
    after = F.greatest(F.col("pos") + F.col("n"), F.col("pos") + window)
    to_right = F.least(F.coalesce(after + F.get("sizes", after), F.size("units")), F.size("units")) - F.col("pos") - F.col("n")
    to_left = F.least("pos", F.lit(max(window, shingle_units - 1)))
    # an extension is placed where it begins; its run's last bit tells the side
    run = F.xxhash64("h").bitwiseAND(-2)
    sides = F.array(
        F.when(F.col("left") & (to_left > 0), F.struct(run.alias("run"), F.col("place").alias("place"), F.reverse(
            F.slice("units", F.col("pos") + 1 - to_left, to_left)).alias("ext"))),
        F.when(F.col("right") & (to_right > 0), F.struct((run + 1).alias("run"), (F.col("place") + F.col("n")).alias("place"),
                                                         F.slice("units", F.col("pos") + F.col("n") + 1, to_right).alias("ext"))))
    ends = (found.join(edges.hint("shuffle_hash"), "h").withColumn("doc", F.shiftright("place", POS_BITS)).withColumn("pos", pos)
                 .join(order.select("doc", "row").hint("shuffle_hash"), "doc")
                 .join(units.select("row", "units", "sizes").hint("shuffle_hash"), "row")
                 .select(F.inline(sides)).filter(F.col("run").isNotNull()))
    reach = _reaches(pinned(ends, "ends", "zstd")).withColumn("doc", F.shiftright("place", POS_BITS))
    longer = reach.select("doc", F.when(F.col("run").bitwiseAND(1) == 0, pos - F.col("far")).otherwise(pos).alias("first"),
                          F.col("far").alias("n"))
    runs = sided.groupBy("doc", "stretch").agg(F.min("pos").alias("first"), F.max("end").alias("end"))
    runs = runs.select("doc", "first", (F.col("end") - F.col("first")).alias("n")).unionByName(longer)
    gone = runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("gone"))
    return gone.join(order.select("doc", "id", "th", "of"), "doc").select("id", "th", "of", "gone")


def kept_ranges(gone: Column, units: Column) -> Column:
    """What is left of ``units`` units without the sorted runs ``gone``: ``(first, n)``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,n:int>>").alias("out"))

    def step(a: Column, r: Column) -> Column:
        kept = F.when(r["first"] > a["at"], F.array(F.struct(a["at"].alias("first"), (r["first"] - a["at"]).alias("n")))).otherwise(
            F.array().cast("array<struct<first:int,n:int>>"))
        return F.struct(F.greatest(a["at"], r["first"] + r["n"]).alias("at"), F.concat(a["out"], kept).alias("out"))

    end = F.array(F.struct(units.alias("first"), F.lit(0).alias("n")))
    return F.aggregate(F.concat(gone, end), start, step)["out"]


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        unit_words: int = UNIT_WORDS, shingle_units: int = SHINGLE_UNITS, min_chars: int = MIN_CHARS,
                        window: int = WINDOW) -> DataFrame:
    """``docs`` without later repeated runs in ``text_col``; with ``removed_units`` and ``removed_chars``."""
    plain, at = own_names(docs)
    key, text = F.col(at[id_col]), F.col(at[text_col])
    gone = repeated_units(plain.select(key.alias("id"), text.alias("text")), unit_words,
                          shingle_units, min_chars, window)
    both = (plain.withColumn("row_th", F.xxhash64(text))
                 .join(gone.hint("shuffle_hash"), key.eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th")), "left"))
    both = computed(both, *at.values(), "of", F.when(F.col("gone").isNotNull(), kept_ranges(F.col("gone"), F.col("of"))).alias("left"))
    # a text that loses all of its units, or none, is not cut again
    both = computed(both, *at.values(), "of", "left", F.when(F.size("left") > 0, line_units(text, unit_words)).alias("cut"))
    pieces = F.flatten(F.transform("left", lambda r: F.slice("cut", r["first"] + 1, r["n"])))
    cut = computed(both, *at.values(), F.coalesce(F.col("of") - F.aggregate("left", F.lit(0), lambda n, r: n + r["n"]), F.lit(0)).alias("lost"),
                   F.when(F.col("left").isNull(), text).when(F.col("cut").isNull(), "").otherwise(F.array_join(pieces, "")).alias("kept"))
    out = [F.col("kept" if c == text_col else n).alias(c) for c, n in at.items()
           if c not in ("removed_units", "removed_chars")]
    return cut.select(*out, F.col("lost").alias("removed_units"),
                      F.coalesce(F.length(text) - F.length("kept"), F.lit(0)).cast("long").alias("removed_chars"))
