"""Personal data by a semi-Markov conditional random field (operator 10).

A segmentation of a text is a sequence of entities and of stretches outside any entity. The field
scores whole segments: weight of the type plus weights of features of the entire candidate span
(checks that its digits pass, its punctuation, the words before it). Stretches outside score 0 and have no
length limit; entities are at most `MOST_CHARS` long. So the best segmentation is found by dynamic
programming over the ends of the candidates alone, jointly choosing boundaries and types; text
without candidates costs nothing but the search for them.

Base spans (the fixed patterns) stay whatever the field says; the field chooses among the other
candidates, and among overlapping ones: names after a title, keys and passwords, social security and
account numbers, street addresses, and numbers that fail a base check or are written loosely.

Weights are trained here by gradient ascent on the conditional likelihood of segmentations, on a
bounded sample (`train_rows` documents with a candidate, the first `text_candidates` of each) whose segmentations come from checks that
a candidate's characters carry themselves (checksums, ranges, lengths, key words).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_text, stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same matches without trying a run of digits again from each of its digits, nor giving parts of a run back: a
#: match takes its last run whole, so none starts after a digit.
LINEAR = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": BASE["phone"],
}
#: An email is found from its @: the domain to the right, then all characters of the local part to the left.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: Characters without which a kind has no match.
FIRST = {"email": "@", "phone": "+"}
#: Patterns of the further candidates, and the type each one proposes.
MORE = {
    "secret": re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?[^\s,;]{6,64}|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,40}\b|\bsk-[A-Za-z0-9_-]{20,60}", re.I),
    "ssn": re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Madame|Monsieur)\.? [A-ZÀ-Þ][\w'-]+(?: [A-ZÀ-Þ][\w'-]+)?"),
    "address": re.compile(r"\b[0-9]{1,5} [A-Z][a-z]+(?: [A-Z][a-z]+)? (?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd)\b"),
    "phone": re.compile(r"\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b"),
}
TYPES = (*KINDS, *[k for k in MORE if k not in KINDS])
#: Longest entity that the field may add; base spans have no limit.
MOST_CHARS = 80
CUES = re.compile(r"(?:mail|phone|tel|call|fax|card|visa|account|iban|ssn|ip|host|server|contact|name|address|key|password|token)\W*$", re.I)
FEATURES = ("bias", "base", "valid", "cue", "digit_share", "upper_share", "mixed", "long", "inside_word")
#: Tests that must see one of these characters or words before a pattern is tried at all.
GATE = re.compile(r"[0-9@=:]|Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Se[ñn]or|Madame|Monsieur")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def passes(kind: str, span: str) -> bool:
    """The check of a base pattern's match."""
    if kind == "ip":
        return all(map(small_number, span.split(".")))
    if kind == "card":
        digits = _digits(span)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(span)) <= 15
    return True


def base_matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """The spans that `BASE[kind].finditer` yields, in time linear in the text also on long runs of one character class."""
    if kind != "email":
        yield from (m.span() for m in LINEAR[kind].finditer(text))
        return
    low, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = low + len(text[low:at].rstrip(LOCAL)) if domain else at
        if start < at:
            yield start, domain.end()
        low = domain.end() if start < at else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind and start."""
    return [(k, start, end) for k, kind in enumerate(KINDS) if FIRST.get(kind, "") in text
            for start, end in base_matches(kind, text) if passes(kind, text[start:end])]


def well_formed(kind: str, span: str) -> bool:
    """Whether the characters of a further candidate carry a proof of their own."""
    if kind == "ssn":
        a, b, c = span.split("-")
        return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    if kind == "iban":
        text = span.replace(" ", "")
        if not 15 <= len(text) <= 34:
            return False
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1
    if kind == "secret":
        value = re.split(r"[=:]\s?", span)[-1]
        return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    if kind == "phone":
        return len(_digits(span)) == 10 and _digits(span)[0] not in "01"
    return True


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, type, base) of every segment the field may choose."""
    base = base_spans(text)
    out = [(start, end, kind, True) for kind, start, end in base]
    taken = {(start, end) for start, end, _, _ in out}
    for kind, pattern in MORE.items():
        for m in pattern.finditer(text):
            if m.end() - m.start() <= MOST_CHARS and (m.start(), m.end()) not in taken:
                out.append((m.start(), m.end(), TYPES.index(kind), False))
    return sorted(out)


def features(text: str, start: int, end: int, kind: int, base: bool) -> np.ndarray:
    span = text[start:end]
    n = len(span)
    digits = sum(c.isdigit() for c in span) / n
    upper = sum(c.isupper() for c in span) / n
    inside = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return np.array([1.0, base, base or well_formed(TYPES[kind], span), CUES.search(text[max(0, start - 24):start]) is not None,
                     digits, upper, 0.1 < digits < 0.9, n > 30, inside], float)


class Field:
    """Weights: one row of features per type."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def scores(self, text: str, cands: list) -> np.ndarray:
        return np.array([self.weights[c[2]] @ features(text, *c) for c in cands])

    def best(self, text: str, cands: list) -> list[tuple[int, int, int]]:
        """Entities of the best segmentation: base spans stay, further ones are chosen around them."""
        free = [c for c in cands if not c[3]]
        fixed = [c for c in cands if c[3]]
        free = [c for c in free if not any(c[0] < e and s < c[1] for s, e, _, _ in fixed)] if len(fixed) < 64 else _apart(free, fixed)
        free.sort(key=lambda c: c[1])
        chosen = best_segments([(c[0], c[1]) for c in free], self.scores(text, free) if free else np.zeros(0))
        return [(s, e, k) for s, e, k, _ in fixed] + [free[i][:3] for i in chosen]


def _apart(free: list, fixed: list) -> list:
    """Candidates that overlap no base span, for texts with very many of either."""
    marks = sorted((s, e) for s, e, _, _ in fixed)
    starts = [s for s, _ in marks]
    reach = np.maximum.accumulate([e for _, e in marks])
    at = np.searchsorted(starts, [c[1] for c in free]) - 1
    return [c for c, k in zip(free, at) if k < 0 or reach[k] <= c[0]]


def best_segments(spans: list[tuple[int, int]], scores: np.ndarray) -> list[int]:
    """Indices of the disjoint segments with the largest total score; spans are sorted by end.
    best[i] is the best total that uses only the first i candidates, all else being outside."""
    ends = [e for _, e in spans]
    best, used = [0.0] * (len(spans) + 1), [False] * len(spans)
    before = np.searchsorted(ends, [s for s, _ in spans], side="right")
    for i, score in enumerate(scores):
        with_it = best[before[i]] + score
        used[i] = score > 0 and with_it > best[i]
        best[i + 1] = max(best[i], with_it) if used[i] else best[i]
    out, i = [], len(spans)
    while i:
        if used[i - 1]:
            out.append(i - 1)
            i = int(before[i - 1])
        else:
            i -= 1
    return out[::-1]


def marginals(spans: list[tuple[int, int]], scores: np.ndarray) -> tuple[np.ndarray, float]:
    """Probability of each candidate under the field, and the log partition; spans sorted by end."""
    n = len(spans)
    ends, starts = [e for _, e in spans], [s for s, _ in spans]
    before = np.searchsorted(ends, starts, side="right")
    forward = np.zeros(n + 1)
    for i in range(n):
        forward[i + 1] = np.logaddexp(forward[i], forward[before[i]] + scores[i])
    by_start = np.argsort(starts, kind="stable")
    sorted_starts = np.array(starts)[by_start] if n else np.zeros(0)
    backward = np.zeros(n + 1)  # over candidates in the order of their starts
    after = np.searchsorted(sorted_starts, ends, side="left") if n else np.zeros(0, int)
    for j in range(n - 1, -1, -1):
        i = by_start[j]
        backward[j] = np.logaddexp(backward[j + 1], scores[i] + backward[after[i]])
    return np.exp(np.array([forward[before[i]] + scores[i] + backward[after[i]] for i in range(n)]) - forward[n]), float(forward[n])


def labelled(text: str, cands: list) -> list[int]:
    """The training segmentation: base spans and self-proving candidates, leftmost longest first."""
    order = sorted(range(len(cands)), key=lambda i: (not cands[i][3], cands[i][0], cands[i][0] - cands[i][1]))
    chosen: list[int] = []
    for i in order:
        s, e, kind, base = cands[i]
        if (base or well_formed(TYPES[kind], text[s:e])) and all(e <= cands[j][0] or cands[j][1] <= s for j in chosen):
            chosen.append(i)
    return chosen


def fit(texts: list[str], rounds: int = 60, rate: float = 0.5, penalty: float = 0.01, text_candidates: int = 200) -> Field:
    """Gradient ascent on the penalised conditional log-likelihood of the training segmentations. Of each training text
    the first `text_candidates` candidates count; the search itself has no such bound."""
    rows = []
    for text in texts:
        cands = sorted(candidates(text)[:text_candidates], key=lambda c: c[1])
        if cands:
            gold = np.zeros(len(cands))
            gold[labelled(text, cands)] = 1
            rows.append(([(c[0], c[1]) for c in cands], np.array([c[2] for c in cands]), np.stack([features(text, *c) for c in cands]), gold))
    weights = np.zeros((len(TYPES), len(FEATURES)))
    weights[:, 0], weights[:, 2] = -1.0, 2.0  # prior mean: what carries a proof is an entity
    mean = weights.copy()
    for _ in range(rounds if rows else 0):
        slope = np.zeros_like(weights)
        for spans, kinds, x, gold in rows:
            p, _ = marginals(spans, (weights[kinds] * x).sum(1))
            np.add.at(slope, kinds, (gold - p)[:, None] * x)
        weights += rate * (slope / len(rows) - penalty * (weights - mean))
    return Field(weights)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, s, e in spans)


def report_of(text: str, field: Field) -> tuple[list[int], str, str]:
    """Counts of the base kinds, digest of the base spans, all spans."""
    if not GATE.search(text):
        return [0] * len(KINDS), hashlib.sha256(b"").hexdigest(), ""
    cands = candidates(text)
    base = sorted((k, s, e) for s, e, k, is_base in cands if is_base)
    told = joined([(KINDS[k], s, e) for k, s, e in base])
    chosen = sorted((k, s, e) for s, e, k in field.best(text, cands))
    return ([sum(1 for b in base if b[0] == k) for k in range(len(KINDS))], hashlib.sha256(told.encode()).hexdigest(),
            joined([(TYPES[k], s, e) for k, s, e in chosen]))


def train(docs: DataFrame, text_col: str = "text", train_rows: int = 2000) -> Field:
    """Fits on at most `train_rows` documents with a candidate, those with the smallest hashes."""
    text = F.col(f"`{text_col}`")
    likely = docs.select(text.alias("text")).where(text.rlike(r"[0-9]{3}|@|[=:]\S")).withColumn("h", F.xxhash64("text"))
    # hashes are picked first, so that only the sample's texts reach the driver
    least = likely.select("h").distinct().orderBy("h").limit(train_rows)
    picked = likely.join(F.broadcast(stored(least, "op10-sample")), "h").dropDuplicates(["h"])
    return fit(sorted(r["text"] for r in picked.collect()))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, field: Field | None = None,
               train_rows: int = 2000) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Null and empty texts have no spans. Every text is searched whole; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col, train_rows) if field is None else field)
    kind = pa.struct([*[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])

    @F.arrow_udf("struct<n_email: long, n_ip: long, n_card: long, n_phone: long, base_sha256: string, spans: string>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in batches:
            rows = [report_of(t, own) for t in as_text(texts).to_pylist()]
            counts = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(KINDS))]
            yield pa.StructArray.from_arrays([*counts, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], fields=list(kind))

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), scan(F.col(f"`{text_col}`")).alias("s")).select("doc_id", "s.*")
