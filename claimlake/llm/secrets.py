"""Secret scans in DataFrame expressions: three patterns, and sliding-window entropy over candidate strings.

Patterns find assignments to names of secrets, access keys and long hexadecimal numbers. Besides, maximal runs of each
character class (hexadecimal in either case, base64) are candidates; a window slides over a candidate while the counts of its
characters are kept up to date, one added and one removed at each step, and so is the sum of c*log2(c) that gives the
window's Shannon entropy. The windows that reach the class's entropy make a span, from the first's start to the last's end.
Candidates that lack a digit or a letter are suppressed, and so are spans that lie within one match of the allow-list as a
whole: a run of its words and sequences, or a candidate that is a UUID or repeats itself. The patterns' spans always stay.

A window's counts are packed into longs, and places are running sums by stretches, so that a text costs in proportion to its length, however many matches it has.

Spans count code points, ends exclusive. Null counts as the empty text; a text without finds has zero counts and an
empty list of spans. Repeated rows are scanned alike. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, in the order in which spans at the same place are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_NAME = "(?i)(?:pass(?:word|wd)|secret|token|api_?key)[\"'\\x20:=]"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
# Fixed values end.

#: Name, alphabet, pattern of candidates, window in characters, bits of entropy a window needs.
CLASSES = (
    ("hex", "0123456789abcdefABCDEF", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])", 20, 2.75),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}", 24, 3.9),
)
#: Words and sequences that mean nothing, as runs of any length, and whole candidates of two kinds.
ALLOWED = (
    r"(?i)(?:[+/_=-]*(?:example|sample|placeholder|dummy|lorem|0123456789(?:abcdef)?|abcdefghij(?:klmnopqrstuvwxyz)?))+[+/_=-]*"
    r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^(.{1,4})\1+.{0,4}$"
)


#: Values that are added up one by one for each place; those of the stretches before are added once.
STRETCH = 256


def _let(value: Column, body) -> Column:
    """body of a value that is worked out once; what a lambda takes from outside is worked out again at each of its calls."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(values: Column, start: Column, step, stretch: int = STRETCH) -> Column:
    """For each place of an array of ints what `step` makes, from `start`, of all values before it, without going through all of them again."""

    def by_stretch(own: Column) -> Column:
        numbers = F.when(F.size(own) > 0, F.sequence(F.lit(0), F.floor((F.size(own) - 1) / stretch).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
        totals = F.transform(numbers, lambda b: F.aggregate(F.slice(own, b * stretch + 1, F.lit(stretch)), start, step))
        return F.aggregate(totals, F.array(start), lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x))))

    def each(own: Column, starts: Column) -> Column:
        return F.transform(own, lambda _, i: F.aggregate(F.slice(own, i - i % stretch + 1, i % stretch), F.get(starts, F.floor(i / stretch).cast("int")), step))

    return _let(values, lambda own: _let(by_stretch(own), lambda starts: each(own, starts)))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (begin, end, value): where the pattern's matches are, and what the group holds.

    The pieces between the matches, as split gives them, and the matches themselves add up to the places.
    """
    whole, held = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    found = F.arrays_zip(whole.alias("whole"), held.alias("held"), F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), lambda x: F.length(x)).alias("gap"))

    def placed(own: Column) -> Column:
        before = _before(F.transform(own, lambda x: x["gap"] + F.length(x["whole"])), F.lit(0), lambda done, x: done + x)
        return F.zip_with(own, before, lambda x, at: F.struct((at + x["gap"]).alias("begin"), (at + x["gap"] + F.length(x["whole"])).alias("end"), x["held"].alias("value")))

    return _let(found, placed)


def _none() -> Column:
    return F.expr("cast(array() as array<struct<begin:int,end:int,value:string>>)")


def _found(text: Column, gate: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The matches of a pattern whose group has enough characters; texts that the gate shuts out are not searched."""
    found = _matches(text, pattern, group)
    return F.when(gate, F.filter(found, lambda x: F.length(x["value"]) >= least) if least else found).otherwise(_none())


#: Counts of a window stand in longs, so many to each, in so many bits.
COUNTS_A_LONG, COUNT_BITS = 12, 5


def _hot(candidate: Column, alphabet: str, window: int, bits: float) -> Column:
    """(first, last): starts of the first and the last window that reach the entropy; -1 if none does.

    The counts of the window's characters are packed into a few longs, of which a step changes two fields.
    """
    if window >= 1 << COUNT_BITS:
        raise ValueError("a window's counts need more bits")
    code = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    step_of = lambda own: F.transform(own, lambda c, i: F.struct(c.alias("new"), F.when(i >= window, F.get(own, i - window)).otherwise(F.lit(-1)).alias("old"), i.alias("at")))
    steps = _let(code, step_of)
    zeros = F.array(*[F.lit(0).cast("long")] * -(-len(alphabet) // COUNTS_A_LONG))
    start = F.struct(zeros.alias("counts"), F.lit(0.0).alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    most = window * (log2(window) - bits) + 1e-9  # the sum of c*log2(c) that a window may have
    sums = F.array(*(F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)))
    word, shift = lambda at: F.floor(at / COUNTS_A_LONG).cast("int"), lambda at: (at % COUNTS_A_LONG) * COUNT_BITS
    one = F.lit(1).cast("long")

    def count(state: Column, at: Column) -> Column:
        return F.call_function("shiftright", F.get(state["counts"], word(at)), shift(at)).bitwiseAND((1 << COUNT_BITS) - 1).cast("int")

    def slide(state: Column, step: Column) -> Column:
        full = step["old"] >= 0
        here = lambda at, j: F.when((at >= 0) & (word(at) == j), F.call_function("shiftleft", one, shift(at))).otherwise(F.lit(0).cast("long"))
        counts = F.transform(state["counts"], lambda held, j: held + here(step["new"], j) - here(step["old"], j))
        # the old character's count, 1 as well before the window is full, which changes nothing, and the new one's without it
        removed = F.when(full, count(state, step["old"])).otherwise(F.lit(1))
        before = count(state, step["new"]) - (full & (step["old"] == step["new"])).cast("int")
        changed = lambda n, m: state["total"] + F.when(full, F.get(sums, n - 1) - F.get(sums, n)).otherwise(F.lit(0.0)) + F.get(sums, m + 1) - F.get(sums, m)
        begin = step["at"] - (window - 1)

        def state_of(total: Column) -> Column:
            hot = (begin >= 0) & (total <= most)
            first = F.when(hot & (state["first"] < 0), begin).otherwise(state["first"])
            return F.struct(counts.alias("counts"), total.alias("total"), first.alias("first"), F.when(hot, begin).otherwise(state["last"]).alias("last"))

        return _let(removed, lambda n: _let(before, lambda m: _let(changed(n, m), state_of)))

    kind = "struct<counts:array<bigint>,total:double,first:int,last:int>"
    return F.aggregate(steps, start.cast(kind), lambda state, step: slide(state, step).cast(kind), lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")))


def _measured(alphabet: str, window: int, bits: float):
    def span(x: Column) -> Column:
        hot = _hot(x["value"], alphabet, window, bits)
        return F.struct(hot.alias("hot"), x["begin"].alias("begin"), x["value"].alias("value"))

    return span


def _unlisted(window: int):
    """Whether a candidate has a span that no match of the allow-list covers."""

    def kept(x: Column) -> Column:
        covers = lambda m: (m["begin"] <= x["hot"]["first"]) & (m["end"] >= x["hot"]["last"] + window)
        return (x["hot"]["first"] >= 0) & ~F.when(x["value"].rlike(ALLOWED), F.exists(_matches(x["value"], ALLOWED), covers)).otherwise(F.lit(False))

    return kept


def _span_of(window: int):
    return lambda x: F.struct((x["begin"] + x["hot"]["first"]).alias("begin"), (x["begin"] + x["hot"]["last"] + window).alias("end"))


def _entropy_spans(text: Column) -> Column:
    spans = []
    for _, alphabet, pattern, window, bits in CLASSES:
        candidates = F.filter(_found(text, text.rlike(pattern), pattern), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
        spans.append(F.transform(F.filter(F.transform(candidates, _measured(alphabet, window, bits)), _unlisted(window)), _span_of(window)))
    return F.array_distinct(F.concat(*spans))


def _marked(kind_no: int):
    return lambda x: F.struct(x["begin"].alias("begin"), F.lit(kind_no).alias("kind_no"), x["end"].alias("end"))


def spans_of(text: Column) -> Column:
    """Array of (begin, kind_no, end) of a text that isn't null, sorted; kind_no is the place in KINDS."""
    arrays = (
        _found(text, text.rlike(ASSIGN_NAME), ASSIGN, 1, 6),
        _found(text, F.contains(text, F.lit("AKIA")), ACCESS),
        _found(text, text.rlike(HEX), HEX),
        _entropy_spans(text),
    )
    return F.array_sort(F.concat(*(F.transform(found, _marked(k)) for k, found in enumerate(arrays))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) of every row."""
    return docs.select(F.col(id_col), spans_of(F.coalesce(F.col(text_col), F.lit(""))).alias("found"))


def listed(found: Column) -> Column:
    """kind:begin:end of the spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(kinds, x["kind_no"]), x["begin"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each pattern, a digest of the patterns' spans, and all spans, of every row."""
    found = scan(docs, id_col, text_col)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind_no"] == k)).cast("long")
    base = F.filter("found", lambda x: x["kind_no"] < 3)
    return found.select(id_col, *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), count(3).alias("n_entropy"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of the text replaced by the mark; overlapping spans become one. Null texts stay null; other columns stay as they are."""
    name = "found"
    while name in docs.columns:
        name += "_"
    text, found = F.coalesce(F.col(text_col), F.lit("")), F.col(name)
    done = _before(F.transform(found, lambda x: x["end"]), F.lit(0), lambda furthest, end: F.greatest(furthest, end))
    new = lambda x, at: F.when(x["begin"] >= at, F.concat(F.substring(text, at + 1, x["begin"] - at), F.lit(mark))).otherwise("")
    rest = F.substring(text, F.array_max(F.transform(found, lambda x: x["end"])) + 1, F.length(text))
    clean = F.concat(F.array_join(F.zip_with(found, done, new), ""), rest)
    with_found = docs.withColumn(name, spans_of(text))
    return with_found.withColumn(text_col, F.when(F.size(found) > 0, clean).otherwise(F.col(text_col))).drop(name)
