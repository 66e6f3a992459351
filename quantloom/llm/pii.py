"""Operator 10: personal data by candidate gradient boosting, with DataFrame functions only.

Base patterns with their checks give the base spans. Wider generators propose further, overlapping candidates; each is
described by small integers of its format and context. Boosted trees, fitted on counts of these descriptions over all
documents, become CASE expressions, and a threshold per kind, calibrated on a fourth of the documents, selects the
candidates to add. A document never leaves its row, so nothing is shuffled but the counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import packed, table

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive forms match what the plain ones do, without deep recursion on long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: The generators' patterns: written-out at and dot, other alphabets, longer addresses; whole runs of digit groups for cards
#: and phone numbers, of which every part in the form of FORM is proposed. A look-ahead asks for as many digits as a card or
#: a phone number has at least, so that texts full of short numbers propose nothing.
_NAME, _AT = r"(?:(?<![\p{L}\p{N}._%+-])|\G)[\p{L}\p{N}._%+-]++", r" ?(?:@|[(\[{] ?(?:at|AT) ?[)\]}]) ?[\p{L}\p{N}-]++"
WIDE = {
    "email": _NAME + _AT + r"(?: ?(?:\.|[(\[{] ?(?:dot|DOT) ?[)\]}]) ?[\p{L}\p{N}-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9]{1,3}+\.){3}+[0-9]{1,3}+|(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+)(?![0-9A-Fa-f:]|\.[0-9])",
    "card": r"(?<![0-9])(?=(?:[0-9][ ./_-]{0,2}){12})[0-9]++(?:[ ./_-]{1,2}[0-9]++)*+",
    "phone": r"(?<![0-9])(?=(?:[ ().+/-]{0,3}[0-9]){9})(?:\+ ?)?\(?[0-9]++(?:[ ()./-]{1,3}[0-9]++)*+",
}
#: The same without a dot that ends a sentence: a dot has spaces on both sides or on none.
_TIGHT_EMAIL = _NAME + _AT + r"(?:(?:\.| \. | ?[(\[{] ?(?:dot|DOT) ?[)\]}] ?)[\p{L}\p{N}-]++)++"
#: What a part of a run must look like, and how many groups it has at most.
FORM = {
    "card": (r"^[0-9]{3,19}+(?:[ ./_-]{1,2}[0-9]{2,7}+){0,6}+$", 7),
    "phone": (r"^(?:\+ ?)?\(?[0-9]{1,4}+(?:[ ()./-]{1,3}[0-9]{2,5}+){1,5}+$", 6),
}
#: Words before a span that tell what it is.
HINTS = {"email": r"(?i)mail|contact|kontakt|correo|courriel", "ip": r"(?i)\bip\b|host|server|addr", "card": r"(?i)card|visa|karte|carte|tarjeta|pay", "phone": r"(?i)tel|phone|call|fax|mobil|ruf"}
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
_SPAN = "array<struct<s: int, e: int, t: string>>"
_PLACE = "array<struct<s: int, e: int>>"
FEATURES = ("digits", "seps", "marks", "before", "after", "hint", "valid", "size", "shape")
#: Forms in which people write the kinds, the base patterns' own and others. A candidate of such a form that isn't a base span
#: may be personal data, so it is no negative.
SHAPE = {
    "email": r"^[^@ ()\[\]{}]+ ?(?:@|[(\[{] ?(?:at|AT) ?[)\]}]) ?[\p{L}\p{N}-]+(?:(?:\.| \. | ?[(\[{] ?(?:dot|DOT) ?[)\]}] ?)[\p{L}\p{N}-]+)*(?:\.| \. | ?[(\[{] ?(?:dot|DOT) ?[)\]}] ?)\p{L}{2,}$",
    "ip": r"^[0-9.]+$|^(?=.*(?:[0-9A-Fa-f]{3}|[A-Fa-f][0-9A-Fa-f]?:[0-9A-Fa-f]:)).*:",
    "card": r"^[0-9]{12,19}$|^[0-9]{4}([ ./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}$|^[0-9]{4}([ ./_-]{1,2})[0-9]{6}\2[0-9]{4,5}$",
    "phone": r"^\+|^00[1-9]|^\([0-9]{2,5}\)|^[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$|^1([ .-])[0-9]{3}\2[0-9]{3}\2[0-9]{4}$",
}


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap, as structs of start, end (exclusive, in code points) and text."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, t: F.struct(F.length(g).alias("g"), t.alias("t")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(a: Column, x: Column) -> Column:
        s = a["at"] + x["g"]
        e = s + F.length(x["t"])
        return F.when(x["t"].isNull(), a).otherwise(F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["t"].alias("t")))).alias("out")))

    return F.aggregate(pieces, start, add, lambda a: a["out"])


def _for(kind: str, f: Callable[[str, Column], Column]) -> Callable[[Column], Column]:
    """f for one kind, as a function of one column."""
    return lambda c: f(kind, c)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The checksum of card numbers; digits is a string of 1 to 19 digits."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    value = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.translate(c, "0123456789", "0246813579").cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_valid(kind: str, t: Column) -> Column:
    digits = _digits(t)
    size = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": t.rlike(_OCTETS),
        "card": F.when(size.between(12, 19), luhn(digits)).otherwise(F.lit(False)),
        "phone": size.between(9, 15),
    }[kind]


def _needs(text: Column) -> list[Column]:
    """For each kind a cheap test (column may_<kind>) that every text with a base span or a candidate passes."""
    digits = text.rlike("[0-9]")
    may = {
        "email": text.contains("@") | (text.rlike(r"(?:at|AT) ?[)\]}]") & text.rlike(r"[(\[{] ?(?:at|AT) ?[)\]}]")),
        "ip": text.rlike(r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]"),
        "card": digits & text.rlike("[0-9][ ./_-]{0,2}[0-9]"),
        "phone": digits & (text.rlike(r"[0-9][ ().0-9/-]{0,2}[0-9]") | text.rlike(BASE["phone"])),
    }
    return [may[k].alias(f"may_{k}") for k in KINDS]


def _found(kind: str, pattern: str, text: str = "text") -> Column:
    return F.when(F.col(f"may_{kind}"), matches(F.col(text), pattern)).otherwise(F.array().cast(_SPAN))


def with_base(docs: DataFrame) -> DataFrame:
    """docs (with a column text, never null) and a column base_<kind> of the base spans of each kind."""
    raw = docs.select("*", *_needs(F.col("text"))).select("*", *[_found(k, BASE[k]).alias(f"raw_{k}") for k in KINDS])
    return raw.select("*", *[F.filter(f"raw_{k}", _for(k, lambda kind, x: is_valid(kind, x["t"]))).alias(f"base_{k}") for k in KINDS]).drop(*[f"raw_{k}" for k in KINDS])


def _bucket(value: Column, *edges: int) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + (value >= e).cast("int")
    return out


def _described(kind: str, c: Column, text: Column) -> Column:
    """A candidate with its features: small whole numbers of its format and of what stands around it."""
    t, digits = c["t"], F.length(_digits(c["t"]))
    letter = r"[\p{L}\p{N}]"
    before = F.substring(text, F.greatest(c["s"] - 23, F.lit(1)), F.least(c["s"], F.lit(24)))
    if kind == "email":
        valid = t.rlike(r"^[^@ ]+@[^@ ]+\.[A-Za-z]{2,}$")
    elif kind == "ip":
        valid = t.rlike(_OCTETS) | t.contains(":")
    else:
        valid = is_valid(kind, t)
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"),
        _bucket(digits, 1, 4, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 20).alias("digits"),
        _bucket(F.length(F.regexp_replace(t, r"[\p{L}\p{N}]", "")), 1, 2, 3, 4, 6).alias("seps"),
        (t.startswith("+").cast("int") + 2 * t.contains("(").cast("int") + 4 * t.contains("@").cast("int")).alias("marks"),
        (F.when(c["s"] > 0, F.substring(text, c["s"], F.lit(1)).rlike(letter)).otherwise(F.lit(False))).cast("int").alias("before"),
        F.substring(text, c["e"] + 1, F.lit(1)).rlike(letter).cast("int").alias("after"),
        before.rlike(HINTS[kind]).cast("int").alias("hint"),
        valid.cast("int").alias("valid"),
        _bucket(F.length(t), 8, 12, 16, 24).alias("size"),
        t.rlike(SHAPE[kind]).cast("int").alias("shape"),
    )


def _over(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def _all_base() -> Column:
    """The base spans of all kinds, by start."""
    return F.array_sort(F.concat(*[F.transform(f"base_{k}", lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"))) for k in KINDS]))


def _masked(text: Column, spans: Column) -> Column:
    """text with the characters of spans (by start) replaced by one that no pattern takes, so that all positions stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(a: Column, b: Column) -> Column:
        s = F.greatest(a["at"], b["s"])
        e = F.greatest(s, b["e"])
        return F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, s - a["at"]), F.repeat(F.lit("\ufffc"), e - s)).alias("out"), e.alias("at"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)


def _parts(kind: str, runs: str) -> Column:
    """All parts of the runs, from one digit group to another, that have the kind's form and pass its check; they overlap."""
    form, most = FORM[kind]

    def parts(r: Column) -> Column:
        def at(g: Column, i: Column) -> Column:
            # The brackets and the plus right before the first group belong to the part.
            lead = F.when(F.lit(kind == "phone"), F.length(F.regexp_extract(F.substring(r["t"], 1, F.when(i == 0, g["s"]).otherwise(F.lit(0))), r"(?:\+ ?)?\(?$", 0))).otherwise(F.lit(0))
            lead = F.when((i > 0) & F.lit(kind == "phone"), (F.substring(r["t"], F.greatest(g["s"], F.lit(1)), F.lit(1)) == "(").cast("int")).otherwise(lead)
            s = g["s"] - lead

            def to(j: Column) -> Column:
                e = r["groups"][j]["e"]
                return F.struct((r["s"] + s).alias("s"), (r["s"] + e).alias("e"), F.substring(r["t"], s + 1, e - s).alias("t"))

            return F.filter(F.transform(F.sequence(i, F.least(i + most - 1, F.size(r["groups"]) - 1)), to), lambda c: (F.length(c["t"]) >= 9) & (F.length(c["t"]) <= 40) & c["t"].rlike(form))

        return F.filter(F.flatten(F.transform(r["groups"], at)), lambda c: is_valid(kind, c["t"]))

    with_groups = F.transform(runs, lambda r: F.struct(r["s"].alias("s"), r["t"].alias("t"), matches(r["t"], "[0-9]++").alias("groups")))
    return F.flatten(F.transform(with_groups, parts))


def with_candidates(docs: DataFrame) -> DataFrame:
    """The columns of with_base and a column desc_<kind> of described candidates of each kind, which may overlap.

    Numbers and addresses are searched in the text without its base spans, so that no candidate loses its place to one;
    the candidates of email may hold a base span, but then no dot that may end a sentence.
    """
    out = docs.select("*", _masked(F.col("text"), _all_base()).alias("masked"))
    out = out.select("*", F.array_distinct(F.concat(F.filter(_found("email", WIDE["email"]), lambda c: ~_is_base("email", c)), _found("email", _TIGHT_EMAIL))).alias("wide_email"), *[_found(k, WIDE[k], "masked").alias(f"wide_{k}") for k in KINDS[1:]])
    out = out.withColumns({f"wide_{k}": _parts(k, f"wide_{k}") for k in FORM}).drop("masked")
    out = out.select("*", *[F.transform(f"wide_{k}", _for(k, lambda kind, c: _described(kind, c, F.col("text")))).alias(f"desc_{k}") for k in KINDS])
    # An address with a number above 255 is none, whatever stands around it.
    return out.drop(*[f"wide_{k}" for k in KINDS]).withColumn("desc_ip", F.filter("desc_ip", lambda c: c["valid"] == 1))


def _is_base(kind: str, c: Column) -> Column:
    return F.exists(f"base_{kind}", lambda b: _over(b, c))


@dataclass
class Boosted:
    """For each kind its start value, its trees as (feature, bound, left, right) or a leaf's number, and its threshold."""

    start: dict[str, float] = field(default_factory=dict)
    trees: dict[str, list] = field(default_factory=dict)
    threshold: dict[str, float] = field(default_factory=dict)


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    if depth and len(x) > 1:
        best = (1e-6, None, None)
        total = grad.sum() ** 2 / (hess.sum() + 1)
        for f in range(x.shape[1]):
            for bound in np.unique(x[:, f])[1:]:
                left = x[:, f] < bound
                gain = grad[left].sum() ** 2 / (hess[left].sum() + 1) + grad[~left].sum() ** 2 / (hess[~left].sum() + 1) - total
                if gain > best[0]:
                    best = (gain, f, int(bound))
        if best[1] is not None:
            left = x[:, best[1]] < best[2]
            return (FEATURES[best[1]], best[2], _grow(x[left], grad[left], hess[left], depth - 1), _grow(x[~left], grad[~left], hess[~left], depth - 1))
    return float(0.3 * grad.sum() / (hess.sum() + 1))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, bound, left, right = tree
    return np.where(x[:, FEATURES.index(f)] < bound, _value(left, x), _value(right, x))


def boost(rows: list[tuple], *, rounds: int = 12, depth: int = 3, precision: float = 0.98) -> tuple[float, list, float]:
    """Logistic boosting on counted descriptions: rows of (features..., part, n, positives); part 1 calibrates the threshold.

    The threshold is the smallest score from which on the calibrating candidates are base spans with the asked
    precision; without such a score nothing is selected (infinity).
    """
    a = np.array(rows, float).reshape(-1, len(FEATURES) + 3)
    fit, check = a[a[:, -3] == 0], a[a[:, -3] == 1]
    x, n, pos = fit[:, : len(FEATURES)], fit[:, -2], fit[:, -1]
    start = float(np.log((pos.sum() + 1) / (n.sum() - pos.sum() + 1)))
    raw, trees = np.full(len(x), start), []
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-raw))
        trees.append(_grow(x, pos - n * p, n * p * (1 - p), depth))
        raw = raw + _value(trees[-1], x)
    value = np.full(len(check), start) + sum(_value(t, check[:, : len(FEATURES)]) for t in trees)
    order = np.argsort(-value, kind="stable")
    value, n, pos = value[order], np.cumsum(check[order, -2]), np.cumsum(check[order, -1])
    last = np.concatenate((value[1:] != value[:-1], [True])) if len(value) else np.zeros(0, bool)
    good = last & (pos >= precision * n) & (value > 0)
    # Rounded up a little short of the smallest good score, so that sums in another order still reach it.
    return start, trees, float(value[good].min()) - 1e-9 if good.any() else float("inf")


def _training_row(kind: str, c: Column, positive: bool) -> Column:
    return F.struct(F.lit(kind).alias("kind"), *[c[f].alias(f) for f in FEATURES], F.lit(int(positive)).alias("is_base"))


def _training_rows(kind: str) -> Column:
    """The kind's base spans as positives, and as negatives the candidates that meet none of them and have neither a usual form nor a hint."""
    base = F.transform(f"base_{kind}", lambda b: _training_row(kind, _described(kind, b, F.col("text")), True))
    other = F.filter(f"desc_{kind}", lambda c: ~_is_base(kind, c) & (c["shape"] == 0) & (c["hint"] == 0))
    return F.concat(base, F.transform(other, lambda c: _training_row(kind, c, False)))


def _rewritten(kind: str, t: Column) -> list[Column]:
    """A base span in the forms that the base patterns miss; null where a form doesn't apply."""
    digits = _digits(t)
    if kind == "email":
        host = lambda by: F.concat(F.substring_index(t, "@", 1), F.lit(by[0]), F.regexp_replace(F.substring_index(t, "@", -1), r"\.", by[1]))
        return [host(by) for by in ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" {at} ", " {dot} "), (" @ ", " . "), ("(at)", "."))] + [F.concat(F.lit("é"), t)]
    if kind == "ip":
        h = F.md5(t)
        return [F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.regexp_replace(h.substr(4 * i + 1, F.lit(4)), zeros, "")), ":") for zeros in ("^$", "^0{1,3}")]
    if kind == "card":
        joins = (".", "/", "_", " - ", "  ")
        by_four = [F.when(F.length(digits) > 12, F.regexp_replace(digits, r"(?<=^(?:[0-9]{4}|[0-9]{8}|[0-9]{12}))", by)) for by in joins]
        return by_four + [F.when(F.length(digits) == 15, F.regexp_replace(digits, "^([0-9]{4})([0-9]{6})", f"$1{by}$2{by}")) for by in joins]
    last = F.substring(digits, -10, 10)
    forms = ("($1) $2-$3", "($1)$2-$3", "($1) $2 $3", "$1-$2-$3", "$1.$2.$3", "$1 $2 $3", "1-$1-$2-$3", "001 $1 $2 $3", "0049 $1 $2$3", "+1/$1/$2/$3", "+ 1 $1 $2 $3")
    return [F.when(F.length(digits) >= 10, F.regexp_replace(last, "^([0-9]{3})([0-9]{3})([0-9]{4})$", f)) for f in forms]


def _drawn(based: DataFrame) -> DataFrame:
    """Training rows of base spans in other forms, between the words that stood around them: a candidate with just the drawn
    span is a positive, one that meets it in part a negative."""

    def around(kind: str, b: Column) -> Column:
        before = F.substring(F.col("text"), F.greatest(b["s"] - 23, F.lit(1)), F.least(b["s"], F.lit(24)))
        return F.struct(F.lit(kind).alias("kind"), before.alias("before"), b["t"].alias("t"), F.substring(F.col("text"), b["e"] + 1, F.lit(24)).alias("after"))

    def by_kind(f: Callable[[str], Column]) -> Column:
        return reduce(lambda out, k: out.when(F.col("kind") == k, f(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], f(KINDS[0])))

    spans = based.select("part", F.explode(F.concat(*[F.transform(f"base_{k}", _for(k, around)) for k in KINDS])).alias("b")).select("part", "b.*")
    texts = spans.select("part", "kind", "before", "after", F.explode(by_kind(lambda k: F.array(*_rewritten(k, F.col("t"))))).alias("t")).where("t IS NOT NULL")
    texts = texts.select("part", "kind", F.concat("before", "t", "after").alias("text"), F.length("before").alias("s"), (F.length("before") + F.length("t")).alias("e"))
    drawn, c = F.struct(F.col("s"), F.col("e")), F.col("c")
    # Base spans that a drawn text holds are cut out of it, so that what is found beside them is known already.
    rows = with_candidates(with_base(texts)).select("part", "kind", "s", "e", F.explode(F.filter(by_kind(lambda k: F.col(f"desc_{k}")), lambda x: _over(x, drawn))).alias("c"))
    equal = (c["s"] == F.col("s")) & (c["e"] == F.col("e"))
    return rows.select("part", F.struct("kind", *[c[f].alias(f) for f in FEATURES], equal.cast("int").alias("is_base")).alias("c"))


def fit(docs: DataFrame, *, text_col: str = "text") -> Boosted:
    """Fits on counts over all documents.

    Base spans are the positives, as they stand and rewritten in other forms; see _training_rows and _drawn for the
    negatives. A fourth of the documents, by a hash of their text, calibrates the thresholds. The descriptions are small
    whole numbers, so that what comes to the driver is bounded by their combinations, whatever the number of documents.
    """
    picked = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    picked = picked.withColumn("part", (F.pmod(F.xxhash64(F.lit(6), "text"), F.lit(4)) == 0).cast("int"))
    based = with_base(picked)
    rows = with_candidates(based).select("part", F.explode(F.concat(*map(_training_rows, KINDS))).alias("c")).unionByName(_drawn(based))
    counted = rows.groupBy("c.kind", *[f"c.{f}" for f in FEATURES], "part").agg(F.count("*").alias("n"), F.sum("c.is_base").alias("pos")).collect()
    model = Boosted()
    for k in KINDS:
        mine = sorted(tuple(r)[1:] for r in counted if r.kind == k)
        model.start[k], model.trees[k], model.threshold[k] = boost(mine)
    return model


def _tree_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    f, bound, left, right = tree
    return f"CASE WHEN c.{f} < {bound} THEN {_tree_sql(left)} ELSE {_tree_sql(right)} END"


def _selected(model: Boosted, kind: str) -> Column:
    """The candidates whose score reaches the kind's threshold, longer ones first where they overlap, cut to their parts outside the base spans."""
    score = " + ".join([f"{model.start[kind]!r}D", *map(_tree_sql, model.trees[kind])])
    good = F.expr(f"array_sort(transform(filter(desc_{kind}, c -> {score} >= {model.threshold[kind]!r}D), c -> struct(c.s - c.e AS n, c.s AS s, c.e AS e)))")
    taken = F.aggregate(good, F.array().cast(_PLACE), lambda a, c: F.when(F.exists(a, lambda x: _over(x, c)), a).otherwise(F.concat(a, F.array(F.struct(c["s"].alias("s"), c["e"].alias("e"))))))
    return F.filter(F.flatten(F.transform(taken, _outside)), lambda c: F.substring(F.col("text"), c["s"] + 1, c["e"] - c["s"]).rlike(r"[\p{L}\p{N}]"))


def _outside(c: Column) -> Column:
    """The parts of a span outside all base spans."""
    start = F.struct(c["s"].alias("at"), F.array().cast(_PLACE).alias("out"))

    def add(a: Column, b: Column) -> Column:
        before = F.when(b["s"] > a["at"], F.array(F.struct(a["at"].alias("s"), b["s"].alias("e")))).otherwise(F.array().cast(_PLACE))
        return F.struct(F.greatest(a["at"], b["e"]).alias("at"), F.concat(a["out"], before).alias("out"))

    def close(a: Column) -> Column:
        return F.when(a["at"] < c["e"], F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), c["e"].alias("e"))))).otherwise(a["out"])

    return F.aggregate(F.filter(F.col("all_base"), lambda b: _over(b, c)), start, add, close)


def find_pii(docs: DataFrame, model: Boosted | None = None, *, text_col: str = "text") -> DataFrame:
    """docs with the columns base and spans: arrays of (start, kind, end), by start, then kind in the order of KINDS.

    Positions count code points, the end is exclusive; kind is a number into KINDS. base holds the matches of the base
    patterns that pass their checks, spans these and the candidates that the model selects. Of selected candidates of one
    kind that overlap the longest stays; what meets base spans of any kind is cut to the parts outside them. Without a model spans
    equals base. A null text counts as empty and has none. All columns and rows of docs stay, repeated ones included;
    columns named base or spans are replaced.
    """
    found = found_rows(docs, model, text_col=text_col)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("base", "spans")], "base", "spans")


def found_rows(docs: DataFrame, model: Boosted | None = None, *, text_col: str = "text") -> DataFrame:
    """find_pii with all columns of docs as one struct: row, text (never null), base and spans; so no column of docs can clash."""
    inner = docs.select(packed(docs)).select("row", F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = with_base(inner)
    numbered = lambda k, column: F.transform(column, lambda x: F.struct(x["s"].alias("start"), F.lit(KINDS.index(k)).alias("kind"), x["e"].alias("end")))
    base = F.array_sort(F.concat(*[numbered(k, F.col(f"base_{k}")) for k in KINDS]))
    live = [k for k in KINDS if model and np.isfinite(model.threshold[k])]
    if not live:
        return found.select("row", "text", base.alias("base")).withColumn("spans", F.col("base"))
    found = with_candidates(found).withColumn("all_base", _all_base())
    chosen = [_selected(model, k).alias(f"more_{k}") for k in live]
    found = found.select("row", "text", base.alias("base"), *chosen)
    return found.select("row", "text", "base", F.array_sort(F.concat("base", *[numbered(k, F.col(f"more_{k}")) for k in live])).alias("spans"))


def redact(docs: DataFrame, model: Boosted | None = None, *, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with each span of find_pii replaced by its kind in brackets; overlapping spans become one, named by the first.

    Where that changes a text, length_col, if docs has it, takes the new number of characters. All other columns and
    rows stay as they are, whatever their names; a null text stays null.
    """
    found = found_rows(docs, model, text_col=text_col)
    text = F.col("text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    label = lambda x: F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)), F.lit("]"))

    def add(a: Column, x: Column) -> Column:
        cut = F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), label(x)).alias("out"), x["end"].alias("at"))
        return F.when(x["start"] >= a["at"], cut).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], x["end"]).alias("at")))

    clean = F.aggregate("spans", start, add, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    told = found.select("row", F.when(F.size("spans") > 0, clean).alias("clean"))
    new = {text_col: F.col("clean")} | ({length_col: F.length("clean").cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})
    return told.select(*[(F.when(F.col("clean").isNotNull(), new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])), ",")


def _told(found: DataFrame) -> list[Column]:
    """What is said of the base spans: their numbers by kind, and the digest of all of them."""
    counts = [F.size(F.filter("base", _for(i, lambda kind, x: x["kind"] == kind))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return ["doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256")]


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit(docs))
    return found.select(*_told(found), written("spans").alias("spans"))


def base_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans that op10_pii starts from, which SQL can express."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(*_told(found))


def _pieces_sql(kind: str, pattern: str, check: str) -> str:
    """Matches of a pattern with their places: what stands before a match is what splitting at the matches leaves."""
    return f"""{kind}_m AS (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS gs FROM d WHERE regexp_matches(text, '{pattern}')),
{kind}_x AS (SELECT doc_id, i, ms[i] AS t, list_sum(list_transform(gs[1 : i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda m: length(m))), 0) AS s FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM {kind}_m)),
{kind}_s AS (SELECT doc_id, {KINDS.index(kind)} AS k, '{kind}' AS kind, s, s + length(t) AS e FROM {kind}_x WHERE {check})"""


_DIGITS = "regexp_replace(t, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j: CASE WHEN (length({_DIGITS}) - j) % 2 = 0 THEN {_DIGITS}[j]::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][{_DIGITS}[j]::INT + 1] END)) % 10 = 0"""
BASE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_pieces_sql("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true")},
{_pieces_sql("ip", "[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)", "list_bool_and(list_transform(string_split(t, '.'), lambda p: p::HUGEINT <= 255))")},
{_pieces_sql("card", "[0-9](?:[ -]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}")},
{_pieces_sql("phone", "[+][0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")},
a AS (SELECT * FROM email_s UNION ALL SELECT * FROM ip_s UNION ALL SELECT * FROM card_s UNION ALL SELECT * FROM phone_s),
g AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)}, string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS w FROM a GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in KINDS)}, sha256(coalesce(w, '')) AS base_sha256 FROM d LEFT JOIN g USING (doc_id)
"""
