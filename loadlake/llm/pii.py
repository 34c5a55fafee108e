"""Personal data: fixed patterns, and candidates chosen by boosted trees; DataFrame functions only.

Patterns take the longest run they can and drop it whole if its check fails, so a phone number followed by a card number
is lost. Candidate generators propose narrower, overlapping spans with high recall. A candidate is described by yes/no
features of its format and its surroundings. Candidates equal to an accepted pattern span are examples of personal data,
candidates that fail their kind's check or lie in another kind's accepted span are counterexamples, all others are
unknown. Whether a candidate passes its check is no feature. Trees are boosted on the counts of feature combinations (at most 2 to the number of features rows, whatever the
number of documents). Each kind's threshold is calibrated on documents that the trees did not see.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, written so that the matcher neither goes back nor starts inside a run; matches are the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap sign of each kind, searched before its pattern.
SIGNS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": "\\+[0-9]"}

#: Generators: kind, sign and pattern. They overlap on purpose.
GENERATORS = (
    ("email", "@", r"[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (
        "email",
        "[\\[(][aA][tT][\\])]",
        r"[A-Za-z0-9._%+-]++ ?[\[(][aA][tT][\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(][dD][oO][tT][\])]|\.) ?[A-Za-z0-9-]++)++",
    ),
    ("ip", "[0-9]\\.[0-9]", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    ("card", "[0-9]{4}", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", "[0-9]{4}[ -][0-9]{4}", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    ("phone", "\\+[0-9]", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])"),
    ("phone", "\\+[0-9]{9}", r"\+[0-9]{9,15}(?![0-9])"),
    ("phone", "[0-9]{3}[ .-][0-9]{4}", r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
)

FEATURES = (
    "is_email", "is_ip", "is_card", "many_digits", "plus", "grouped", "brackets",
    "joined_before", "joined_after", "listed", "very_many_digits", "named",
)
_NAMES = r"(?i)(mail|contact|tel|phone|call|fax|mobile|card|visa|credit|payment|host|address|server|\bip)[^\n]{0,12}$"
CONTEXT = 30
PIECE = 1000
BLOCK = 64
#: A piece: up to ``PIECE`` characters of a line, and on to where the line may be cut.
_CUT = rf'[^\n]{{0,{PIECE}}}(?:[^\n,;|<>"A-Za-z]|[A-Za-z](?! [A-Za-z0-9+]))*+(?:[A-Za-z](?= )|[\n,;|<>"])?+'
#: What every span has.
ANY_SIGN = r"@|[\[(][aA][tT][\])]|[0-9]\.[0-9]|[0-9]{2}|[0-9][ -][0-9]|\+[0-9]"
TREES = 24
RATE = 0.4
PRECISION = 0.95

SPAN = "struct<kind:int,start:int,end:int,value:string>"


def _pieces(text: Column) -> Column:
    """The text cut into ``text, offset`` where no span can be cut: at line ends, and in lines of more than
    ``PIECE`` characters also behind characters that no pattern has, or before a space between words. Only pieces with a
    sign of something are returned; all later work is piece by piece, so it grows in proportion to the text.

    Offsets are summed block by block, since appending to one array would copy it each time.
    """
    parts = F.regexp_extract_all(text, F.lit(_CUT), F.lit(0))
    n = F.size(parts)
    block = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (n - 1) / BLOCK).cast("int")), lambda b: F.slice(parts, b * BLOCK + 1, F.lit(BLOCK))
    )
    sums = F.transform(block, lambda some: F.aggregate(some, F.lit(0), lambda total, x: total + F.length(x)))

    def summed(lengths: Column) -> Column:
        """Sums before each element."""
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(
            lengths, start, lambda done, x: F.struct((done["at"] + x).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")), lambda d: d["out"]
        )

    def placed(some: Column, before: Column) -> Column:
        inside = summed(F.transform(some, F.length))
        every = F.zip_with(some, inside, lambda t, at: F.struct(t.alias("text"), (before + at).alias("offset")))
        return F.filter(every, lambda p: p["text"].rlike(ANY_SIGN))

    return F.when(text.rlike(ANY_SIGN), F.flatten(F.zip_with(block, summed(sums), placed))).otherwise(
        F.expr("cast(array() as array<struct<text:string,offset:int>>)")
    )


def _found(text: Column, kind: int, sign: str, pattern: str) -> Column:
    """All matches in a piece as an array of spans; places in code points come from the lengths of the pieces between matches."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("out"))

    def add(done: Column, piece: Column) -> Column:
        first = done["at"] + piece["gap"]
        end = first + F.length(piece["value"])
        span = F.struct(F.lit(kind).alias("kind"), first.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    every = F.aggregate(pieces, start, add, lambda done: done["out"])
    return F.when(text.rlike(sign), every).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.greatest(F.length(digits) - 1, F.lit(0))), F.lit(0), add) % 10 == 0


def passes(kind: Column, value: Column) -> Column:
    """The check of each kind: octets, number of digits and checksum, number of digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    octets = F.forall(F.split(value, "\\."), lambda x: x.rlike("^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, octets)
        .when(kind == 2, F.length(digits).between(13, 19) & luhn(F.when(F.length(digits) <= 19, digits).otherwise("1")))
        .otherwise(F.length(digits).between(9, 15))
    )


def _base(text: Column) -> Column:
    kinds = [F.filter(_found(text, i, SIGNS[k], PATTERNS[k]), lambda s: passes(s["kind"], s["value"])) for i, k in enumerate(KINDS)]
    return F.concat(*kinds)


def _candidates(text: Column) -> Column:
    return F.array_distinct(F.concat(*[_found(text, KINDS.index(kind), sign, pattern) for kind, sign, pattern in GENERATORS]))


def _code(text: Column, span: Column) -> Column:
    """The candidate's features as bits of a number, in the order of ``FEATURES``."""
    before = F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), span["start"]))
    after = F.substring(text, span["end"] + 1, F.lit(3))
    value = span["value"]
    flags = (
        span["kind"] == 0,
        span["kind"] == 1,
        span["kind"] == 2,
        F.length(F.regexp_replace(value, "[^0-9]", "")) > 10,
        value.startswith("+"),
        value.rlike("[0-9][ .-][0-9]"),
        value.contains("("),
        before.rlike("[A-Za-z0-9_@.]$"),
        after.rlike("^[A-Za-z0-9_@]"),
        before.rlike("(^|[,;:(=] ?)$"),
        F.length(F.regexp_replace(value, "[^0-9]", "")) > 15,
        before.rlike(_NAMES),
    )
    code = F.lit(0)
    for bit, flag in enumerate(flags):
        code = code + F.when(flag, 1 << bit).otherwise(0)
    return code


def _with_parts(docs: DataFrame) -> DataFrame:
    """Adds ``parts``: per piece with a sign its ``offset``, ``base`` spans and ``candidates`` (with ``code`` and ``ok``,
    whether the kind's check passes), all counted from the piece's start. Null text counts as empty.
    """

    def part(p: Column) -> Column:
        told = F.transform(
            _candidates(p["text"]),
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                _code(p["text"], s).alias("code"),
                passes(s["kind"], s["value"]).alias("ok"),
            ),
        )
        plain = F.transform(_base(p["text"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return F.struct(p["offset"].alias("offset"), plain.alias("base"), told.alias("candidates"))

    return docs.withColumn("parts", F.transform(_pieces(F.col("text")), part))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass(frozen=True)
class Boosted:
    """Trees of two questions, ``(first, second if no, second if yes, four leaves)``; an offset; thresholds by kind."""

    trees: list[tuple[int, int, int, tuple[float, float, float, float]]]
    offset: float
    thresholds: tuple[float, ...]

    def margins(self, bits: np.ndarray) -> np.ndarray:
        total = np.full(len(bits), self.offset)
        for first, no, yes, leaves in self.trees:
            a = bits[:, first]
            b = np.where(a, bits[:, yes], bits[:, no])
            total += np.array(leaves)[2 * a + b]
        return total

    def margin(self, code: Column) -> Column:
        """The same as an expression over a candidate's code."""

        def has(bit: int) -> Column:
            return code.bitwiseAND(F.lit(1 << bit)) > 0

        total = F.lit(self.offset)
        for first, no, yes, leaves in self.trees:
            with_yes = F.when(has(yes), leaves[3]).otherwise(leaves[2])
            with_no = F.when(has(no), leaves[1]).otherwise(leaves[0])
            total = total + F.when(has(first), with_yes).otherwise(with_no)
        return total


def bits_of(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] >> np.arange(len(FEATURES))) & 1


def boost(codes: np.ndarray, positive: np.ndarray, negative: np.ndarray, trees: int = TREES) -> Boosted:
    """Gradient boosting on counted feature combinations, by Newton steps with ridge 1; thresholds are 0 as yet."""
    bits = bits_of(codes)
    weight = positive + negative
    offset = math.log((positive.sum() + 1) / (negative.sum() + 1))
    margin = np.full(len(codes), offset)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = positive - weight * p, weight * p * (1 - p)

        def split(mask: np.ndarray, gradient: np.ndarray = gradient, curve: np.ndarray = curve) -> tuple[float, int, list[float]]:
            best = (-1.0, 0, [0.0, 0.0])
            for f in range(bits.shape[1]):
                gain, leaves = 0.0, []
                for side in (0, 1):
                    at = mask & (bits[:, f] == side)
                    g, h = gradient[at].sum(), curve[at].sum() + 1
                    gain += g * g / h
                    leaves.append(float(np.clip(g / h, -4, 4)))
                if gain > best[0] + 1e-12:
                    best = (gain, f, leaves)
            return best

        choices = []
        for f in range(bits.shape[1]):
            no, yes = split(bits[:, f] == 0), split(bits[:, f] == 1)
            choices.append((no[0] + yes[0], -f, no, yes))
        _, f, no, yes = max(choices, key=lambda c: c[:2])
        leaves = tuple(RATE * x for x in (*no[2], *yes[2]))
        grown.append((-f, no[1], yes[1], leaves))
        a = bits[:, -f]
        margin += np.array(leaves)[2 * a + np.where(a, bits[:, yes[1]], bits[:, no[1]])]
    return Boosted(grown, offset, (0.0,) * len(KINDS))


def calibrated(model: Boosted, codes: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> Boosted:
    """The lowest threshold of each kind at which the held-out examples above it have the wanted precision."""
    margins = model.margins(bits_of(codes)) if len(codes) else np.zeros(0)
    kind = np.where(codes & 1, 0, np.where(codes & 2, 1, np.where(codes & 4, 2, 3)))
    out = []
    for k in range(len(KINDS)):
        at = np.flatnonzero(kind == k)
        at = at[np.argsort(-margins[at], kind="stable")]
        good, bad = np.cumsum(positive[at]), np.cumsum(negative[at])
        fine = np.flatnonzero((good > 0) & (good >= PRECISION * (good + bad)))
        out.append(max(0.0, float(margins[at[fine[-1]]]) - 1e-9) if len(fine) else math.inf)
    return Boosted(model.trees, model.offset, tuple(out))


def fit(docs: DataFrame) -> Boosted:
    """Trees and thresholds from the candidates of all documents; what reaches the driver is one row per combination."""
    spans = _with_parts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    fold = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0).alias("held_out")
    every = spans.select(fold, F.explode("parts").alias("p")).select("held_out", "p.base", F.explode("p.candidates").alias("c"))
    c = F.col("c")
    same = F.exists("base", lambda b: (b["kind"] == c["kind"]) & (b["start"] == c["start"]) & (b["end"] == c["end"]))
    other = F.exists("base", lambda b: (b["kind"] != c["kind"]) & _overlaps(b, c))
    label = F.when(same, 1).when(~c["ok"] | other, 0)
    counts = every.select("held_out", c["code"].alias("code"), label.alias("label")).where(F.col("label").isNotNull())
    rows = counts.groupBy("held_out", "code").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).collect()
    rows.sort()

    def part(held_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = [r for r in rows if r.held_out == held_out]
        return tuple(np.array([r[k] for r in some], np.int64) for k in ("code", "pos", "neg"))

    codes, pos, neg = part(False)
    if not len(codes):
        return Boosted([], 0.0, (math.inf,) * len(KINDS))
    return calibrated(boost(codes, pos.astype(float), neg.astype(float)), *part(True))


def _kept(added: Column) -> Column:
    """From spans by length, the longest first and equal ones by margin, those that do not overlap one taken before."""
    empty = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    ordered = F.array_sort(added)

    def take(done: Column, s: Column) -> Column:
        span = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        return F.when(F.exists(done, lambda d: _overlaps(d, s)), done).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(ordered, empty, take)


def private_spans(docs: DataFrame, model: Boosted) -> DataFrame:
    """``doc_id, base, spans`` per row: accepted pattern spans, and these with the candidates that the trees add.

    Spans are ``kind`` (place in ``KINDS``), ``start``, ``end`` in code points. An added span overlaps no other. Null text
    has none.
    """
    spans = _with_parts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    limits = [t if math.isfinite(t) else 1e300 for t in model.thresholds]

    def added(p: Column) -> Column:
        def chosen(c: Column) -> Column:
            limit = F.when(c["kind"] == 0, limits[0]).when(c["kind"] == 1, limits[1]).when(c["kind"] == 2, limits[2]).otherwise(limits[3])
            return (model.margin(c["code"]) >= limit) & ~F.exists(p["base"], lambda b: _overlaps(b, c))

        good = F.transform(
            F.filter(p["candidates"], chosen),
            lambda c: F.struct(
                (c["start"] - c["end"]).alias("size"), (-model.margin(c["code"])).alias("order"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")
            ),
        )
        return F.when(F.size(p["candidates"]) > 0, _kept(good)).otherwise(F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)"))

    def moved(spans: Column, by: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), (s["start"] + by).alias("start"), (s["end"] + by).alias("end")))

    told = spans.select(
        "doc_id",
        F.flatten(F.transform("parts", lambda p: moved(p["base"], p["offset"]))).alias("base"),
        F.flatten(F.transform("parts", lambda p: moved(added(p), p["offset"]))).alias("added"),
    )
    return told.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", "added")).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
