"""Secret scanning with a trigram inverted index, in DataFrame operations only.

Each rule is a regular expression; a walk over its parts derives a Boolean query over trigrams
from it: an AND of ORs of trigrams that any match must contain. The index holds postings (trigram, document)
for the trigrams of all queries, taken from lower-cased texts. Intersecting a document's
postings with each query gives candidates, and only candidates meet the regular expression. A
rule from whose expression no mandatory trigram follows scans every text.

The postings of a document are intersected in one aggregation by document, so that a common
trigram, whose posting list may be as long as the corpus, never gathers in one task.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

READINGS = 64  # words that neighbouring parts of an expression may be multiplied out to
BITS = 63  # trigrams of one posting mask
CHUNK = 64  # items of an array that a running value is merged by
BLOCK = 4096  # code points of a block of a text that is cut


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    ``pattern``: the expression (what Python's and Java's expressions share).
    ``value``: the group whose length counts, 0 for the whole match; ``least``: that length.
    """

    kind: str
    pattern: str
    value: int = 0
    least: int = 1

    @property
    def search(self) -> str:
        """The expression that is searched for: with the least length in it, where spans stay the same.

        They do for a word and then a run of characters among which are the word's own: a run
        that is too short holds no other match, so it need not be found first to be dropped.
        """
        run = re.fullmatch(r"(\w*)(\[[^\]\\]+\])\+", self.pattern)
        if self.value or not run or not re.fullmatch(f"{run[2]}*", run[1]):
            return self.pattern
        return f"{run[1]}{run[2]}{{{max(1, self.least - len(run[1]))},}}"


# The three base kinds, in the order that breaks ties.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)

# Further kinds, with published prefixes of well-known credential formats.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", least=20),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
)


def trigrams(word: str) -> list[str]:
    low = word.lower()
    return sorted({low[i : i + 3] for i in range(len(low) - 2)})


def mandatory_words(pattern: str) -> list[list[str]]:
    """Lower-cased literals of which every match of ``pattern`` holds one of each list.

    Neighbouring parts with few readings (letters, small classes, alternatives, optional parts) are
    multiplied out to words; a part with too many readings or of open length ends them. A word
    that contains another of its list says no more than that one and goes.
    """
    clauses: list[list[str]] = []

    def closed(words: set[str]) -> None:
        clauses.append(sorted(w for w in words if not any(v != w and v in w for v in words)))

    def readings(items) -> set[str] | None:
        """All strings that a sequence of parts can be, None if they are many."""
        words = {""}
        for item in items:
            own = part(*item)
            if own is None or len(words) * len(own) > READINGS:
                return None
            words = {a + b for a in words for b in own}
        return words

    def part(op, value) -> set[str] | None:
        if op is parser.LITERAL:
            return {chr(value).lower()}
        if op is parser.IN:
            chars: set[str] = set()
            for kind, own in value:
                if kind is parser.LITERAL:
                    chars.add(chr(own).lower())
                elif kind is parser.RANGE and own[1] - own[0] < READINGS:
                    chars |= {chr(c).lower() for c in range(own[0], own[1] + 1)}
                else:
                    return None
            return chars
        if op is parser.SUBPATTERN:
            return readings(value[3])
        if op is parser.BRANCH:
            each = [readings(x) for x in value[1]]
            return None if None in each else set().union(*each)
        if op is parser.MAX_REPEAT and value[1] <= READINGS:
            own = readings(value[2])
            if own is None or len(own) ** value[1] > READINGS:
                return None
            return set().union(*({"".join(w) for w in itertools.product(own, repeat=n)} for n in range(value[0], value[1] + 1)))
        return {""} if op is parser.AT else None

    def walk(items, words: set[str]) -> set[str]:
        """Read on from ``words``, the possible readings so far; those at the end."""
        for op, value in items:
            own = part(op, value)
            if own is not None and len(own) <= READINGS and len(words) * len(own) <= READINGS:
                words = {a + b for a in words for b in own}
                continue
            closed(words)
            words = {""}
            if op is parser.SUBPATTERN:
                words = walk(value[3], words)
            elif op is parser.MAX_REPEAT and value[0] >= 1:
                closed(walk(value[2], words))
                words = {""}
            elif own is not None and len(own) <= READINGS:
                words = own
        return words

    closed(walk(list(parser.parse(pattern)), {""}))
    return [c for c in clauses if c != [""]]


@functools.cache
def trigram_query(rule: Rule) -> list[list[list[str]]]:
    """AND over OR over AND of trigrams, derived from the rule's expression; empty if none is mandatory."""
    return [[trigrams(w) for w in group] for group in mandatory_words(rule.pattern) if all(len(w) >= 3 for w in group)]


def index_trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for rule in rules for group in trigram_query(rule) for word in group for t in word})


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The inverted index: (trigram number, id, r) for every query trigram in every text."""
    vocabulary = index_trigrams(rules)
    held = F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(vocabulary)))
    return (
        docs.select("id", "r", F.lower("body").alias("low"))
        .select(F.explode(F.array_compact(held)).alias("trigram"), "id", "r")
    )


def _satisfied(rule: Rule, numbers: dict[str, int]) -> Column:
    """Whether a document's masks of trigrams, 63 in each, meet the rule's query."""

    def all_of(word: list[str]) -> Column:
        bits: dict[int, int] = {}
        for t in word:
            bits[numbers[t] // BITS] = bits.get(numbers[t] // BITS, 0) | 1 << numbers[t] % BITS
        return functools.reduce(operator.and_, (F.col(f"mask{m}").bitwiseAND(F.lit(b).cast("long")) == F.lit(b).cast("long") for m, b in bits.items()))

    def any_of(group: list[list[str]]) -> Column:
        return functools.reduce(operator.or_, map(all_of, group))

    return functools.reduce(operator.and_, map(any_of, trigram_query(rule)))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, r, c: one Boolean a rule with a query): postings intersected by document."""
    numbers = {t: i for i, t in enumerate(index_trigrams(rules))}
    bit = F.expr(f"shiftleft(1L, trigram % {BITS})")
    masks = (
        postings(docs, rules)
        .groupBy("id", "r")
        .agg(*(F.bit_or(F.when(F.expr(f"trigram div {BITS} = {m}"), bit).otherwise(F.lit(0).cast("long"))).alias(f"mask{m}") for m in range(-(-len(numbers) // BITS))))
    )
    flags = [_satisfied(r, numbers).alias(f"r{i}") for i, r in enumerate(rules) if trigram_query(r)]
    return masks.select("id", "r", F.struct(*flags).alias("c")).filter(functools.reduce(operator.or_, (F.col("c")[f"r{i}"] for i, r in enumerate(rules) if trigram_query(r))))


SPANS = "array<struct<start:int,ord:int,end:int>>"


def _adds(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _running(frame: DataFrame, names: list[str], merge) -> DataFrame:
    """``frame`` with what ``_upto`` needs of arrays of numbers: merged by chunks, then up to each chunk.

    A running value is not gathered item by item, as a list would be copied with each. All
    columns here are used twice by the next step, so that Spark keeps them as columns and does
    not work them out again for each item.
    """

    def folded(array: Column, first: Column, n: Column) -> Column:
        return F.aggregate(F.slice(array, first, n), F.lit(0), merge)

    def chunks(n: str) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(n) - 1) / CHUNK).cast("int")), lambda c: folded(F.col(n), c * CHUNK + 1, F.lit(CHUNK)))

    def before(n: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(f"{n}_chunks") - 1), lambda c: folded(F.col(f"{n}_chunks"), F.lit(1), c))

    # Not for an empty array, over which a sequence would run backwards.
    frame = frame.withColumns({f"{n}_chunks": F.when(F.size(n) > 0, chunks(n)) for n in names})
    return frame.withColumns({f"{n}_before": F.when(F.size(n) > 0, before(n)) for n in names})


def _upto(name: str, i: Column, merge) -> Column:
    """The merged value of an array's items up to and with item ``i``."""
    chunk = (i / CHUNK).cast("int")
    inside = F.aggregate(F.slice(name, chunk * CHUNK + 1, i - chunk * CHUNK + 1), F.lit(0), merge)
    return F.when(F.size(f"{name}_before") > 0, merge(F.get(f"{name}_before", chunk), inside))


def _spans(rule: Rule, order: int) -> Column:
    """Spans of a rule from its matches m and the running lengths t of matches and what is before them."""
    hits = F.col(f"m{order}")

    def long_enough(i: Column) -> Column:
        hit = F.get(hits, i)
        return F.length(F.regexp_extract(hit, rule.pattern, rule.value) if rule.value else hit) >= rule.least

    def span(i: Column) -> Column:
        end = _upto(f"t{order}", i, _adds)
        return F.struct((end - F.length(F.get(hits, i))).alias("start"), F.lit(order).alias("ord"), end.alias("end"))

    return F.when(F.size(hits) > 0, F.transform(F.filter(F.sequence(F.lit(0), F.size(hits) - 1), long_enough), span)).otherwise(F.array().cast(SPANS))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """``docs`` with ``found``: an array of (start, ord, end), ``ord`` numbering ``rules``.

    Spans are in code points, end exclusive, sorted by start and then by the rule's number.
    Matches of one rule are leftmost and do not overlap; a match whose value is too short is
    dropped but still used up. Other columns stay, whatever their names (an existing ``found`` is
    replaced).

    Edge cases: a null text has no span, as the empty one; a row with a null key is scanned as
    any other; rows that repeat key and text have the same spans; an empty table gives an empty
    one; a text's cost grows with its length, also where it holds many secrets.
    """
    columns = [c for c in docs.columns if c != "found"]
    # The row is one column here, so that no other of its columns can clash with what follows.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    body = F.coalesce(F.col("row")[text], F.lit(""))
    found = rows.withColumn("c", F.lit(None).cast("struct<none:boolean>"))
    if index_trigrams(rules):
        own = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")).withColumn("r", F.xxhash64("body"))
        flagged = Scratch(docs.sparkSession, "secrets").table(candidates(own, rules))
        found = rows.withColumn("hash", F.xxhash64(body)).join(flagged, F.col("row")[key].eqNullSafe(F.col("id")) & (F.col("hash") == F.col("r")), "left").select("row", "c")
    numbers = range(len(rules))
    # Columns of their own, a step for all rules: matches and gaps are searched for once.
    worth = [F.coalesce(F.col("c")[f"r{i}"], F.lit(False)) if trigram_query(r) else F.lit(True) for i, r in enumerate(rules)]
    found = found.select("row", *(F.when(worth[i], F.regexp_extract_all(body, F.lit(r.search), F.lit(0))).alias(f"m{i}") for i, r in enumerate(rules)))
    found = found.select("*", *(F.when(F.size(f"m{i}") > 0, F.split(body, r.search)).alias(f"g{i}") for i, r in enumerate(rules)))
    found = found.select("row", *(f"m{i}" for i in numbers), *(F.zip_with(F.slice(f"g{i}", 1, F.size(f"m{i}")), f"m{i}", lambda g, h: F.length(g) + F.length(h)).alias(f"t{i}") for i in numbers))
    found = _running(found, [f"t{i}" for i in numbers], _adds)
    spans = F.sort_array(F.concat(*(_spans(r, i) for i, r in enumerate(rules))))
    return found.select("row", spans.alias("found")).select(*(F.col("row")[c].alias(c) for c in columns), "found")


def spans_text(found: Column, rules: tuple[Rule, ...], only: tuple[Rule, ...] | None = None) -> Column:
    """kind:start:end, comma-joined; ``only`` restricts it to some of the rules."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    shown = found if only is None else F.filter(found, lambda s: s["ord"] < len(only))
    return F.array_join(F.transform(shown, lambda s: F.concat_ws(":", kinds[s["ord"]], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE + EXTRA, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each found span replaced by ``mark``; overlapping spans become one mark.

    All columns stay (a column ``found`` too); texts without a secret and null texts stay as they are.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns if c != text)).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    found = find_secrets(rows, "key", "body", rules)
    ends = found.select("row", "body", "found", F.transform("found", lambda s: s["end"]).alias("e"))
    # Texts that are cut, in blocks: a stretch is then taken out of its own blocks, not counted off from the text's begin.
    ends = _running(ends, ["e"], _larger).withColumn("blocks", F.when(F.size("found") > 0, F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))

    def taken(start: Column, end: Column) -> Column:
        first = (start / BLOCK).cast("int")
        return F.substring(F.array_join(F.slice("blocks", first + 1, (end / BLOCK).cast("int") - first + 1), ""), start - first * BLOCK + 1, end - start)

    def before(i: Column) -> Column:
        """Where the cuts before span i end."""
        return F.when(i > 0, _upto("e", i - 1, _larger)).otherwise(0)

    # Spans come sorted: one that starts before the last end only lengthens the cut.
    cuts = F.filter(F.sequence(F.lit(0), F.size("found") - 1), lambda i: F.get("found", i)["start"] >= before(i))
    pieces = F.transform(cuts, lambda i: taken(before(i), F.get("found", i)["start"]))
    cut = F.concat(F.array_join(pieces, mark), F.lit(mark), taken(before(F.size("found")), F.length("body")))
    new = ends.select("row", F.when(F.size("blocks") > 0, cut).otherwise(F.col("body")).alias("new"))
    return new.select(*((F.col("new") if c == text else F.col("row")[c]).alias(c) for c in columns))
