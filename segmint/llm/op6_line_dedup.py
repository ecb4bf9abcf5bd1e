"""Line dedup by a segment-partition edit join, in DataFrame operations only.

Lines that are equal, or near each other, belong to one class (links are
followed). Of each class the first line stays (smallest document id, then
position); the others go. Near is one edit for every ``CHARS_PER_EDIT``
characters of the longer line, ``EDITS`` at most: lines of ``MIN_CHARS``
characters or more link within EDITS edits, also with shorter lines, and the
shortest only when equal. Lines under MIN_CHARS without a letter or digit are
layout (blank lines, brackets, rules) and always stay.

Search: a line that may be E edits away from a shorter one is cut into E + 1
segments. Lines within E edits, of lengths m <= n, share at least one segment
of the shorter one as a substring of the longer one, near its own place. So a
line indexes its segments under (length, segment number, content) and probes,
for each length m down to n - E, the few start positions that the multi-match
rule leaves. A line just short of a longer one's E indexes for that E too.
Lines are identified by two 64-bit hashes. Keys are hashed to 64 bits and counted with two extreme line hashes, which is
map-side combined; only keys that two different lines share fetch any text.

Verification: a pair must first agree in all but two characters an edit of a
bit signature. After the common prefix and suffix are cut off (found by
doubling steps), edits remain at both ends of what is left, so for two edits
its inside must occur in the other line. What passes is measured by a
bit-parallel automaton: one bit mask per number of edits over the 2 EDITS + 1
diagonals of the band, all diagonals advanced at once per character. The test
is part of the join condition, so a segment that many lines share yields its
links and never its pairs; both join inputs are written tables, so AQE may
split a hot segment.

Defined cases: a null text has no lines and stays null; an empty text stays
empty; rows that repeat an id and its text are one document (they keep the same
lines); documents with a null id come last in the order; line ends are \\n alone;
very long lines are compared whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release_since, written
from .components import connected_components

EDITS = 2
MIN_CHARS = 20
CHARS_PER_EDIT = MIN_CHARS // EDITS
#: Shared segment keys (8 bytes each) that may be broadcast. Beyond it the join
#: is left to shuffle, first without texts, which are then fetched once a line.
BROADCAST_KEYS = 2_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def probes(edits: int = EDITS) -> list[tuple[int, int, int]]:
    """(length difference, segment from 1, shift of the start position): where
    a line's substrings may equal a segment of a line that is shorter by the
    difference. Difference and shift 0 are the line's own segments."""
    out = []
    for less in range(edits + 1):
        for i in range(1, edits + 2):
            lo = max(-(i - 1), less - (edits + 1 - i))
            hi = min(i - 1, less + (edits + 1 - i))
            out += [(less, i, shift) for shift in range(lo, hi + 1)]
    return out


def cuts(n: Column) -> Column:
    """Array of the places (parts, less, i, shift) to cut a line of n
    characters at: those of its own number of edits, and its own segments for
    the larger numbers that lines a little longer have."""
    def table(places: list[tuple[int, int, int, int]]) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("parts", "less", "i", "shift"), p, strict=True)])
                         for p in places])

    def places(size: int) -> list[tuple[int, int, int, int]]:
        e = min(EDITS, size // CHARS_PER_EDIT)
        out = [(e + 1, *p) for p in probes(e)] if e else []
        for more in range(e + 1, EDITS + 1):
            if size + more >= more * CHARS_PER_EDIT:
                out += [(more + 1, 0, i, 0) for i in range(1, more + 2)]
        return out

    bounds = sorted({e * CHARS_PER_EDIT - back for e in range(1, EDITS + 1) for back in (0, e)}, reverse=True)
    out = F.when(n >= bounds[0], table(places(bounds[0])))
    for size in bounds[1:]:
        out = out.when(n >= size, table(places(size)))
    return out


def segment_keys(rows: DataFrame, line: str = "line") -> DataFrame:
    """``rows`` once for each key of its line, in ``k``, with ``own``: whether
    the key is of the line's own segment (an index entry, and a probe for lines
    of its length) or only a probe for shorter lines or shifted places. The
    places to cut are constant tables that are exploded, so the expression for
    one key is all that is compiled (twelve of them in one array make a method
    that the JIT refuses). Lines are measured once and cut as UTF-32, four bytes
    a character, so that no cut looks for its place from the line's start."""
    p = rows.withColumns({"_n": F.char_length(line), "_u": F.encode(F.col(line), "UTF-32")})
    p = p.withColumn("_p", F.explode(cuts(F.col("_n")))).withColumn("_m", F.col("_n") - F.col("_p.less"))
    i, m, parts = F.col("_p.i"), F.col("_m"), F.col("_p.parts")
    longer = m % parts  # the last m mod parts segments are longer by one
    small = F.expr("_m div _p.parts").cast("int")
    size = small + (i > parts - longer).cast("int")
    start = F.col("_p.shift") + small * (i - 1) + F.greatest(F.lit(0), i - 1 - (parts - longer))
    return p.withColumns({"k": F.xxhash64(m, i, F.substring(F.col("_u"), 4 * start + 1, 4 * size)),
                          "own": (F.col("_p.less") == 0) & (F.col("_p.shift") == 0)}).drop("_n", "_u", "_p", "_m")


def common_prefix(a: Column, b: Column, n: Column) -> Column:
    """Number of characters that two strings begin with alike, at most n."""
    steps = F.transform(F.sequence(F.ceil(F.log2(n + 1.0)).cast("int"), F.lit(0), F.lit(-1)),
                        lambda k: F.pow(F.lit(2.0), k).cast("int"))
    same = lambda at, step: (at + step <= n) & (F.substring(a, at + 1, step) == F.substring(b, at + 1, step))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(same(at, step), at + step).otherwise(at))


def banded_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance if it is at most ``edits``, else edits + 1. Bit d + edits
    of mask e: b's position minus a's can be d after e edits."""
    width = 2 * edits + 1
    full = (1 << width) - 1

    def automaton(sa: Column, sb: Column) -> Column:
        # Characters of b that equal a's i-th, as bits over the diagonals.
        equal = F.transform(sa, lambda c, i: sum(
            (F.when(F.get(sb, i + F.lit(d)) == c, F.lit(1 << (d + edits))).otherwise(F.lit(0)) for d in range(-edits, edits + 1)),
            F.lit(0)))
        names = [f"r{e}" for e in range(edits + 1)]

        def closed(masks: list[Column]) -> Column:
            return F.struct(*[m.alias(n) for n, m in zip(names, masks, strict=True)])

        # Characters of b skipped before the first of a: d rises.
        start = closed([F.lit(((1 << (e + 1)) - 1) << edits & full) for e in range(edits + 1)])

        def step(state: Column, x: Column) -> Column:
            old = [state[n] for n in names]
            new = []
            for e in range(edits + 1):
                m = old[e].bitwiseAND(x)  # same character
                if e:
                    m = m.bitwiseOR(old[e - 1])  # replaced
                    m = m.bitwiseOR(F.shiftright(old[e - 1], 1))  # a's character dropped: d falls
                    m = m.bitwiseOR(F.shiftleft(new[e - 1], 1))  # b's next character added: d rises
                new.append(m.bitwiseAND(F.lit(full)))
            return closed(new)

        last = F.aggregate(equal, start, step)
        off = F.size(sb) - F.size(sa) + edits
        out = F.lit(edits + 1)
        for e in range(edits, -1, -1):
            out = F.when(_bit(last[f"r{e}"], off), F.lit(e)).otherwise(out)
        return out

    far = F.abs(F.char_length(a) - F.char_length(b)) > edits
    letters = lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, "(?!$)"))
    return F.when(far, F.lit(edits + 1)).otherwise(
        let(F.struct(letters(a).alias("a"), letters(b).alias("b")), lambda v: automaton(v["a"], v["b"])))


def _bit(mask: Column, at: Column) -> Column:
    """Whether bit ``at`` (from 0) is set; false outside the mask."""
    return (at >= 0) & (F.floor(mask / F.pow(F.lit(2.0), at)).cast("long") % 2 == 1)


def within(a: Column, b: Column, na: Column, nb: Column, edits: int = EDITS, most: Column | None = None) -> Column:
    """Whether two strings of na and nb characters are within ``edits``, and
    within ``most`` edits if it is given."""
    short = F.least(na, nb)
    limit = F.lit(edits) if most is None else F.least(F.lit(edits), most)

    def after_prefix(p: Column) -> Column:
        ra, rb = F.substring(a, p + 1, na - p), F.substring(b, p + 1, nb - p)
        left = short - p
        suffix = common_prefix(F.reverse(ra), F.reverse(rb), left)
        return let(suffix, lambda s: inside(F.substring(ra, F.lit(1), na - p - s), F.substring(rb, F.lit(1), nb - p - s)))

    def inside(ma: Column, mb: Column) -> Column:
        # Both ends of what is left are edited; with two edits nothing between.
        ok = F.lit(True)
        if edits == 2:
            la = F.char_length(ma)
            ok = (la <= 2) | F.contains(mb, F.substring(ma, F.lit(2), la - 2))
        return F.when(ok, banded_distance(ma, mb, edits) <= limit).otherwise(False)

    return F.when(F.abs(na - nb) > limit, False).otherwise(let(common_prefix(a, b, short), after_prefix))


#: Characters whose presence makes a line's signature.
SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789.,;:!?-()'"


def line_hash(line: str) -> Column:
    """First hash of a line; with ``other_hash`` it identifies the line."""
    return F.xxhash64(line)


def other_hash(line: str) -> Column:
    return F.xxhash64(F.lit(1), line)


def signature(line: str) -> Column:
    """Bits of the SIGNS that the lower-cased line holds. One edit takes one
    character out and puts one in at most, so it changes two bits at most."""
    low = F.lower(line)
    out = F.lit(0).cast("long")
    for k, c in enumerate(SIGNS):
        out = out.bitwiseOR(F.when(F.contains(low, F.lit(c)), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def judged_line(line: Column) -> Column:
    """All lines but short ones without a letter or digit."""
    return (F.char_length(line) >= MIN_CHARS) | line.rlike(r"[\p{L}\p{N}]")


def line_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per judged line: document (id and hash of its text), position
    from 0, line."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return d.where(judged_line(F.col("line")))


def line_links(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct links (x, x2, y, y2) between lines, by their two hashes, that
    are near each other and not equal."""
    line = docs.select(F.explode(F.split(text, "\n")).alias("line"))
    line = line.where((F.char_length("line") >= CHARS_PER_EDIT - 1) & judged_line(F.col("line")))
    keyed = segment_keys(line.select(line_hash("line").alias("id"), "line"))
    shared = keyed.groupBy("k").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select(F.col("k").alias("sk"))
    shared = materialize(shared, "line-keys")
    on = F.col("k") == F.col("sk")
    if shared.count() <= BROADCAST_KEYS:
        members = keyed.join(F.broadcast(shared), on).groupBy("k", "id", other_hash("line").alias("id2")).agg(
            F.min("line").alias("line"), F.max("own").alias("own"))
    else:
        places = keyed.select("k", "id", "own").join(shared, on).groupBy("k", "id").agg(F.max("own").alias("own"))
        places = materialize(places, "line-places")
        wanted = places.select(F.col("id").alias("wid")).distinct()
        texts = line.select(line_hash("line").alias("tid"), "line").join(wanted, F.col("tid") == F.col("wid"), "left_semi")
        texts = materialize(texts.groupBy("tid", other_hash("line").alias("id2")).agg(F.min("line").alias("line")), "line-texts")
        members = places.join(texts, F.col("id") == F.col("tid")).select("k", "id", "id2", "line", "own")
    members = materialize(members.withColumns({"n": F.char_length("line"), "s": signature("line")}), "line-members")
    # The shorter line is found by a segment of its own; of two equally long
    # ones either finds the other.
    a = members.where("own").select("k", F.col("id").alias("x"), F.col("id2").alias("x2"), F.col("line").alias("a"),
                                    F.col("n").alias("na"), F.col("s").alias("sa"))
    b = members.select(F.col("k").alias("kb"), F.col("id").alias("y"), F.col("id2").alias("y2"), F.col("line").alias("b"),
                       F.col("n").alias("nb"), F.col("s").alias("sb"))
    most = F.least(F.lit(EDITS), F.floor(F.greatest("na", "nb") / CHARS_PER_EDIT).cast("int"))
    # Cheap necessary conditions first; few pairs are left for the distance.
    below = (F.col("x") < F.col("y")) | ((F.col("x") == F.col("y")) & (F.col("x2") < F.col("y2")))
    first = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & below)
    may = (F.col("nb") - F.col("na") <= most) & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= 2 * most)
    near = F.when(may, within(F.col("a"), F.col("b"), F.col("na"), F.col("nb"), EDITS, most)).otherwise(False)
    links = a.join(b, (F.col("k") == F.col("kb")) & first & near)
    swapped = [F.when(below, F.col(c)).otherwise(F.col(d)).alias(c) for c, d in (("x", "y"), ("x2", "y2"))]
    swapped += [F.when(below, F.col(d)).otherwise(F.col(c)).alias(d) for c, d in (("x", "y"), ("x2", "y2"))]
    return links.select(*swapped).distinct()


def line_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, th, removed, classes, links) of the documents that have a
    line in a class of two or more: positions that go, their classes, and the
    number of links of all the document's lines."""
    lines = line_rows(docs, text, doc_id).select(
        "doc_id", "th", "pos", line_hash("line").alias("h"), other_hash("line").alias("h2"))
    lines = materialize(lines, "lines")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "pos")
    distinct = lines.groupBy("h", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    links = materialize(line_links(docs, text), "line-links")
    degree = links.select(F.col("x").alias("dh"), F.col("x2").alias("dh2")).union(links.select("y", "y2")).groupBy("dh", "dh2").agg(
        F.count("*").alias("links"))
    node = lambda a, b: F.concat_ws(":", a, b)
    half = lambda c, k: F.split_part(c, F.lit(":"), F.lit(k)).cast("long")
    roots = connected_components(links.select(node("x", "x2").alias("x"), node("y", "y2").alias("y"))).select(
        half(F.col("node"), 1).alias("nh"), half(F.col("node"), 2).alias("nh2"), half(F.col("root"), 1).alias("root"), half(F.col("root"), 2).alias("root2"))
    distinct = materialize(distinct, "line-distinct")
    linked = distinct.join(roots, (F.col("h") == F.col("nh")) & (F.col("h2") == F.col("nh2")), "left")
    linked = linked.join(degree, (F.col("h") == F.col("dh")) & (F.col("h2") == F.col("dh2")), "left")
    # A line without links has a class of its own.
    linked = materialize(linked.where("root is not null or n > 1").select(
        "h", "h2", "first", "n", F.coalesce("root", "h").alias("c"),
        F.coalesce("root2", "h2").alias("c2"), F.coalesce("links", F.lit(0)).alias("links")), "line-linked")
    own = linked.groupBy("c", "c2").agg(F.min("first").alias("keep"))
    own = materialize(own, "line-kept").withColumnsRenamed({"c": "oc", "c2": "oc2"})
    judged = linked.join(own, (F.col("c") == F.col("oc")) & (F.col("c2") == F.col("oc2"))).select(
        F.col("h").alias("jh"), F.col("h2").alias("jh2"), "c", "keep", "links")
    judged = materialize(judged, "line-judged")
    hit = lines.join(judged, (F.col("h") == F.col("jh")) & (F.col("h2") == F.col("jh2")))
    goes = ~(F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("th") == F.col("keep.th")) & (F.col("pos") == F.col("keep.pos")))
    # Rows that repeat an id and its text are one document: a place counts once.
    hit = hit.groupBy("doc_id", "th", "pos").agg(F.first(goes).alias("goes"), F.first("c").alias("c"), F.first("links").alias("links"))
    goes = F.col("goes")
    return hit.groupBy("doc_id", "th").agg(
        F.collect_list(F.when(goes, F.col("pos"))).alias("removed"), F.collect_set(F.when(goes, F.col("c"))).alias("classes"),
        F.sum("links").alias("links"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", out: str = "dedup") -> DataFrame:
    """``docs`` with ``text`` without the lines that go, and struct ``out``:
    lines, removed, classes, links (replaced where it exists)."""
    mark = written(docs.sparkSession)
    found = materialize(line_classes(docs, text, doc_id), "line-decisions")
    release_since(docs.sparkSession, mark, keep=("line-decisions",))
    found = found.select(
        F.col("doc_id").alias("__line_doc"), F.col("th").alias("__line_th"), F.struct("removed", "classes", "links").alias("__line"))
    d = docs.withColumn("__line_hash", F.xxhash64(text)).join(
        found, F.col(doc_id).eqNullSafe(F.col("__line_doc")) & (F.col("__line_hash") == F.col("__line_th")), "left")
    gone = F.coalesce(F.col("__line.removed"), F.array().cast("array<int>"))
    split = F.split(text, "\n")
    new = F.when(F.size(gone) == 0, F.col(text)).otherwise(
        F.array_join(F.filter(split, lambda x, i: ~F.array_contains(gone, i)), "\n"))
    info = F.struct(F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long").alias("lines"),
                    F.size(gone).cast("long").alias("removed"),
                    F.coalesce("__line.classes", F.array().cast("array<bigint>")).alias("classes"),
                    F.coalesce("__line.links", F.lit(0)).cast("long").alias("links"))
    return d.withColumn(out, info).withColumn(text, new).drop("__line_doc", "__line_th", "__line", "__line_hash")


def q_op6(spark, sf):
    """Every row of ``documents``: its text without the lines that go, how
    many lines it had and lost, their classes, and its lines' links."""
    d = dedup_lines(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    return d.select("doc_id", "text", F.col("dedup.lines").alias("n_lines"), F.col("dedup.removed").alias("n_removed"),
                    F.col("dedup.links").alias("n_links"), F.array_sort("dedup.classes").alias("class_ids"))


def line_stage(spark, docs, sf_dir):
    """Pipeline stage: texts lose the lines that go; a document that loses its
    last line with a word goes. Columns stay; others keep their values."""
    d = dedup_lines(docs, out="__dedup")
    worded = F.regexp_replace("text", r"[\x20\x09-\x0D]", "") != ""
    return d.where((F.col("__dedup.removed") == 0) | worded).select(*docs.columns)
