"""Plain versions of what the operators compute, and rows that are hard to handle."""

import re
from collections import Counter
from itertools import pairwise

LONG = "word " * 20_000
TEXTS = [None, "", " ", "\n\n", "a", "The end.", "The end.", LONG, "  two  spaces\n\n and\ttabs ", "ünï 🎉 don't <|endoftext|>"]


def hard_rows(spark, column="text"):
    """Nulls, empty and long texts, repeated rows and ids, and extra columns with names that operators use."""
    rows = [(i, t, None, f"src{i % 2}", i) for i, t in enumerate(TEXTS)]
    rows += [(5, "The end.", "en", None, None), (None, "no id", "en", "src0", 1), (None, None, None, None, None)]
    clashing = "score kept _text k_0 _0 n_ids ids start n_tokens node fingerprint component_id base spans held_out _row".split()
    schema = f"doc_id long, {column} string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in clashing)
    return spark.createDataFrame([(*r, *range(len(clashing))) for r in rows], schema)


def no_rows(spark):
    return hard_rows(spark).filter("false")


def rule_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def components(n, linked):
    """The smallest number each of 0 .. n-1 reaches over the pairs ``linked``."""
    found = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(found[a], found[b])
            changed |= found[a] != found[b]
            found[a] = found[b] = least
    return found


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def personal_data(text):
    kinds = list(PERSONAL)
    found = [(m.start(), kinds.index(k), m.end()) for k in kinds for m in re.finditer(PERSONAL[k], text) if _valid(k, m[0])]
    return ",".join(f"{kinds[k]}:{start}:{stop}" for start, k, stop in sorted(found))


def maximal_segments(scores):
    """By definition: the best segment, then the best ones to its left and right."""

    def within(low, high):
        best = max(((sum(scores[i:j]), i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        return [*within(low, best[1]), best[1:], *within(best[2], high)]

    return within(0, len(scores))


def consecutive(pieces):
    """Whether (start, length) pieces follow each other without gap or overlap."""
    return all(a + n == b for (a, n), (b, _) in pairwise(sorted(pieces)))
