"""Personal data: fixed rules, and boosted trees that judge wider candidates.

Four rules find e-mail addresses, IP addresses, card and phone numbers. Beside them, wider
generators propose spans of the same kinds, and of secrets such as keys and tokens, that may overlap. Trees boosted on format and
context decide about those that no rule covers. They learn other ways of writing from what the rules confirm: confirmed spans are
written anew without what the rule looks at (an e-mail address with its signs in words, a number without its plus or country code, with other
separators), in their own context, and count as positives; unconfirmed candidates that nothing announces count as negatives. A secret
has no rule; values assigned to a name such as token or key are its positives, and the trees see the name, not the assignment. The
threshold of each kind is calibrated on the other half of the documents.

Everything that touches texts or spans is a Spark SQL expression. Candidates are counted by
their features, which are small numbers; only these counts, bounded by the number of combinations, reach
the driver, where the trees are grown. The trees come back as an expression.

Positions count code points, ends are exclusive. NULL texts count as empty and have no spans; spans that start
at the same place are in the order of the kinds; repeated rows are judged alike; without positives a kind has no further
spans; a long text of many matches takes time in proportion, but for a square root; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import stored
from ledgerloom.llm.spans import apart, leading, matches, placed, replaced

KINDS = ("email", "ip", "card", "phone")
# What spans are called; a secret is never found by a rule alone.
ALL_KINDS = (*KINDS, "secret")
# The fixed rules. Lookbehinds and possessive quantifiers keep the search linear and change no match.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The wider generators.
GENERATORS = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[a-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[a-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}+|[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}+(?:[\x20./_-]?[0-9]{2,6}+){2,5}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?+[0-9]{0,3}+[\x20.-]?+\(?+[0-9]{2,4}+\)?+[\x20./-]?+[0-9]{3,4}+[\x20./-]?+[0-9]{3,4}+(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+(?![A-Za-z0-9+/_-])",
}
# Texts that match neither hold no match of the pattern; looking for these is cheap.
_MAY_HOLD = {
    "email": (r"@", r"@|(?i:[(\[{]at[)\]}])"),
    "ip": (r"[0-9]\.[0-9]", r"[0-9]\x20?\.|[0-9A-Fa-f]:[0-9A-Fa-f]"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9]{4}"),
    "phone": (r"\+[0-9]", r"[0-9]{3}"),
    "secret": ("", r"[0-9]"),
}
# How confirmed spans are written anew: patterns and what replaces them, one after the other.
_MASKS = {
    "email": [[(r"@", "(at)"), (r"\.(?=[^@()]*$)", "(dot)")], [(r"@", " [at] "), (r"\.(?=[^\]]*$)", " [dot] ")], [(r"@", " (at) ")]],
    "ip": [[(r"\.", " . ")], [(r"\.", ". ")]],
    "card": [[(r"[^0-9]", ""), (r"([0-9]{4})(?=[0-9])", "$1.")], [(r"[^0-9]", ""), (r"([0-9]{4})(?=[0-9])", "$1/")]],
    "phone": [[(r"^\+", "")], [(r"^\+[0-9]{1,3}[\x20.-]?(?=[(0-9])", "")], [(r"^\+", "00")]],
}
# Words that announce a kind, before the candidate.
_ANNOUNCED = {
    "email": r"mail|contact|write|reach|@",
    "ip": r"\bip|host|server|addr|node",
    "card": r"card|visa|master|amex|credit|pay",
    "phone": r"phone|tel|call|mobile|fax|cell|dial",
    "secret": r"token|secret|passw|key|auth|bearer|credential",
}
# An address with its sign in brackets is no example of what is none.
_IN_WORDS = r"(?i)[(\[{]at[)\]}]"
# What assigns a secret to a name; the trees do not see it.
_ASSIGNED = r"(?:token|secret|passw(?:or)?d|key|auth|bearer|credentials?)[\"']?\s*[:=]\s*[\"']?$"
# What stands before numbers that are nobody's.
_NUMERIC = r"(?:[$€£#=%\"/:]|version|vers\.|no\.|isbn|page|id)\s*$"
_FEATURES = (
    "kind", "digits", "separators", "brackets", "announced", "before", "after", "kinds_of_digits", "first", "numeric", "letters", "turns",
)

TREES = 24
DEPTH = 3
LEARNING_RATE = 0.3
# Share of positives among the candidates above a threshold.
PRECISION = 0.99


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; digits of 14 to 19 places."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        doubled = digit * F.when(place % 2 == 0, 2).otherwise(1)
        return total + doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":

        def small(part: Column) -> Column:
            bare = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(bare) <= 3, F.concat(F.lit("0"), bare).cast("int") <= 255).otherwise(False)

        return F.forall(F.split(value, r"\."), small)
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _class(char: Column) -> Column:
    """0 nothing or white space, 1 a letter, 2 a digit, 3 another character."""
    blank = char.isNull() | F.rlike(char, F.lit(r"^\s*$"))
    return F.when(blank, 0).when(F.rlike(char, F.lit(r"\p{L}")), 1).when(F.rlike(char, F.lit("[0-9]")), 2).otherwise(3)


def _features(kind: str, value: Column, before: Column, after: Column) -> list[Column]:
    """Format and context as small numbers, in the order of ``_FEATURES``; no plus, no check digit, no ranges, no assignment."""
    digits = F.length(_digits(value))
    variety = F.size(F.array_distinct(F.split(_digits(value), "")))
    first = F.length(F.regexp_extract(value, "^[^0-9]*([0-9]+)", 1))
    separators = F.least(F.length(F.regexp_replace(value, r"[^\x20./_-]", "")), F.lit(6))
    is_secret = kind == "secret"  # of any length, so in coarse steps
    columns = [
        F.lit(ALL_KINDS.index(kind)),
        F.floor(F.least(digits, F.lit(40)) / 5) if is_secret else F.least(digits, F.lit(20)),
        F.lit(0) if kind in ("email", "ip") else separators,
        F.rlike(value, F.lit(r"[(\[{]")).cast("int"),
        F.rlike(before, F.lit(_ANNOUNCED[kind])).cast("int"),
        _class(F.right(before, F.lit(1))),
        _class(after),
        F.least(variety, F.lit(10)),
        F.lit(0) if is_secret else F.least(first, F.lit(20)),
        F.rlike(before, F.lit(_NUMERIC)).cast("int"),
        F.floor(F.least(F.length(F.regexp_replace(value, "[^A-Za-z]", "")), F.lit(40)) / 5) if is_secret else F.lit(0),
        F.floor(F.least(F.size(F.split(value, "(?<=[0-9])(?=[A-Za-z])")), F.lit(20)) / 3) if is_secret else F.lit(0),
    ]
    return [c.cast("int").alias(name) for c, name in zip(columns, _FEATURES)]


def _base_spans(kind: str, found: Column) -> Column:
    number = F.lit(KINDS.index(kind))
    right = F.filter(found, lambda s: _confirmed(kind, s["value"]))
    return F.transform(right, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["stop"].alias("stop")))


def _candidate_spans(kind: str, found: Column) -> Column:
    """Spans with features, and ``label``: 1 and 0 teach, -1 does not."""

    def candidate(s: Column) -> Column:
        features = _features(kind, s["value"], s["before"], s["after"])
        announced = F.rlike(s["before"], F.lit(_ANNOUNCED[kind]))
        if kind == "secret":
            label = F.rlike(s["before"], F.lit(_ASSIGNED)).cast("int")
        else:
            unknown = announced | F.rlike(s["value"], F.lit(_IN_WORDS)) if kind == "email" else announced
            label = F.when(unknown, -1).otherwise(0)
        place = [s["start"].alias("start"), F.lit(ALL_KINDS.index(kind)).alias("kind"), s["stop"].alias("stop")]
        return F.struct(*place, label.alias("label"), *features[1:])

    return F.transform(found, candidate)


def _masked(kind: str, found: Column) -> Column:
    """The features of confirmed spans written anew."""

    def variants(s: Column) -> Column:
        rows = []
        for steps in _MASKS[kind]:
            value = reduce(lambda text, step: F.regexp_replace(text, *step), steps, s["value"])
            rows.append(F.struct(*_features(kind, value, s["before"], s["after"])))
        return F.array(*rows)

    right = F.filter(found, lambda s: _confirmed(kind, s["value"]))
    return F.flatten(F.transform(right, variants))


def _searched(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` as k_0, k_1, ..., ``base`` (spans of the rules), ``candidates`` apart from these, and ``masked`` (features)."""
    kept = [as_column(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    body = F.coalesce(as_column(text).cast("string"), F.lit(""))
    found = df.select(*kept, body.alias("_text"))
    names = [(f"{kind}_{i}", kind, i, patterns[kind]) for i, patterns in enumerate((RULES, GENERATORS)) for kind in patterns]
    columns = {}
    for name, kind, i, pattern in names:
        may = F.rlike(F.col("_text"), F.lit(_MAY_HOLD[kind][i]))
        columns[f"{name}_v"], columns[f"{name}_g"] = matches(F.col("_text"), pattern, may)
    found = found.withColumns(columns)
    found = found.withColumns({name: placed(F.col(f"{name}_v"), F.col(f"{name}_g")) for name, *_ in names})

    base = F.array_sort(F.concat(*[_base_spans(kind, F.col(f"{kind}_0")) for kind in KINDS]))
    wide = F.concat(*[_candidate_spans(kind, F.col(f"{kind}_1")) for kind in ALL_KINDS])
    masked = F.concat(*[_masked(kind, F.col(f"{kind}_0")) for kind in KINDS])
    names = [c for c in found.columns if c.startswith("k_")]
    found = found.select(*names, base.alias("base"), wide.alias("wide"), masked.alias("masked"))
    return found.select(*names, "base", apart(F.col("wide"), F.col("base")).alias("candidates"), "masked")


@dataclass(frozen=True)
class Model:
    """Boosted trees as nested tuples (feature, split, below, above) with leaf values, and a threshold for each kind."""

    start: float = 0.0
    trees: tuple = ()
    thresholds: tuple[float, ...] = (1e9,) * len(ALL_KINDS)

    def margin(self, candidate: Column) -> Column:
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, split, below, above = node
            return F.when(candidate[_FEATURES[feature]] <= split, walk(below)).otherwise(walk(above))

        return reduce(lambda total, tree: total + walk(tree), self.trees, F.lit(self.start))

    def selects(self, candidate: Column) -> Column:
        limits = [F.when(candidate["kind"] == i, F.lit(limit)) for i, limit in enumerate(self.thresholds)]
        # both sides as margins: no exponential for each candidate
        return self.margin(candidate) >= F.coalesce(*limits)


def _leaf(gradient: np.ndarray, weight: np.ndarray) -> float:
    return float(LEARNING_RATE * gradient.sum() / (weight.sum() + 1.0))


def _tree(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int):
    """The tree that explains the gradients best, split by split."""
    best = (1e-6, None, None)
    whole = gradient.sum() ** 2 / (weight.sum() + 1.0)
    for feature in range(x.shape[1]) if depth else ():
        size = int(x[:, feature].max()) + 1
        g = np.cumsum(np.bincount(x[:, feature], gradient, size))[:-1]
        h = np.cumsum(np.bincount(x[:, feature], weight, size))[:-1]
        gain = g**2 / (h + 1.0) + (gradient.sum() - g) ** 2 / (weight.sum() - h + 1.0) - whole
        if len(gain) and gain.max() > best[0]:
            best = (float(gain.max()), feature, int(gain.argmax()))
    _, feature, split = best
    if feature is None:
        return _leaf(gradient, weight)
    low = x[:, feature] <= split
    return (feature, split, *[_tree(x[some], gradient[some], weight[some], depth - 1) for some in (low, ~low)])


def _predicted(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, split, below, above = tree
    return np.where(x[:, feature] <= split, _predicted(below, x), _predicted(above, x))


def boost(x: np.ndarray, confirmed: np.ndarray, total: np.ndarray) -> tuple[float, tuple]:
    """Start and trees of a logistic model; row i stands for ``total[i]`` candidates."""
    share = np.clip(confirmed.sum() / max(1, total.sum()), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(x), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(x, confirmed - total * p, total * p * (1 - p), DEPTH)
        margin = margin + _predicted(tree, x)
        trees.append(tree)
    return start, tuple(trees)


def calibrated(margin: np.ndarray, kind: np.ndarray, confirmed: np.ndarray, total: np.ndarray) -> tuple[float, ...]:
    """For each kind the lowest margin from which on a share of PRECISION is positive; out of reach if there is none.

    Few candidates at the top say little: they are weighed with those below them.
    """
    limits = []
    for number in range(len(ALL_KINDS)):
        some = kind == number
        limit = 1e9
        for value in sorted(set(margin[some]), reverse=True):
            above = some & (margin >= value)
            if confirmed[above].sum() >= PRECISION * total[above].sum():
                limit = float(value)
        # just below, so that rounding in another order of sums changes nothing
        limits.append(limit - 1e-9)
    return tuple(limits)


def train(searched: DataFrame, half: Column) -> Model:
    """Trees from the examples of one half of the documents, thresholds from the other."""
    masked = searched.select(half.alias("half"), F.explode("masked").alias("c")).select("half", "c.*", F.lit(1).alias("label"))
    seen = searched.select(half.alias("half"), F.explode("candidates").alias("c")).select("half", "c.*").filter("label >= 0")
    examples = masked.unionByName(seen.select(*masked.columns))
    counts = examples.groupBy("half", *_FEATURES)
    rows = counts.agg(F.count(F.lit(1)).alias("total"), F.sum("label").alias("confirmed")).collect()
    parts = [[r for r in rows if r["half"] == i] for i in (0, 1)]
    if not all(parts):
        return Model()
    (x, confirmed, total), (x_1, confirmed_1, total_1) = (
        (
            np.array([[r[name] for name in _FEATURES] for r in part]),
            np.array([r["confirmed"] for r in part], float),
            np.array([r["total"] for r in part], float),
        )
        for part in parts
    )
    start, trees = boost(x, confirmed, total)
    margin = start + sum((_predicted(tree, x_1) for tree in trees), np.zeros(len(x_1)))
    return Model(start, trees, calibrated(margin, x_1[:, 0], confirmed_1, total_1))


def _chosen(model: Model) -> Column:
    """All spans: those of the rules, and selected candidates unless one that begins before overlaps them."""
    selected = F.transform(
        F.filter(F.col("candidates"), model.selects),
        lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop")),
    )
    added = F.array_sort(F.concat(F.col("base"), leading(F.array_sort(selected))))
    return F.when(F.size("candidates") > 0, added).otherwise(F.col("base"))


def _half(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(2)).cast("int")


def find(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``base`` and ``spans``: arrays of (start, kind number, stop) in order."""
    searched = stored(_searched(df, text, (key,)), "candidates")
    model = train(searched, _half(F.col("k_0")))
    return searched.select(F.col("k_0").alias(key), "base", _chosen(model).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:stop, comma-joined."""
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with every span replaced by its kind in brackets; overlapping spans are replaced once.

    Texts are searched once and stored with what was found; NULL texts stay NULL.
    """
    names = [f"k_{i}" for i in range(len(df.columns))]
    at = df.columns.index(text)
    searched = stored(_searched(df, text, df.columns), "candidates")
    model = train(searched, _half(F.col(names[df.columns.index(key)])))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    body = replaced(F.col(names[at]), F.col("spans"), lambda kind: F.get(tags, kind))
    found = searched.withColumn("spans", _chosen(model))
    return found.select(*[body.alias(n) if i == at else F.col(n) for i, n in enumerate(names)]).toDF(*df.columns)
