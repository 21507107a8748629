"""Personal data in texts: candidate spans judged by gradient boosting.

Four kinds of spans are found by fixed patterns and always count: email, ip,
card and phone. Beyond them, generators of high recall propose spans that may
overlap: written-out addresses, bracketed dots, other separators, numbers
without a country code. Boosted trees judge each by its format and its context,
and a threshold for each kind, calibrated on texts left out of training, selects
what is added. Nothing marks personal data in the tables, so the trees learn
from the fixed patterns' finds, rewritten as people disguise them or set beside
another number, against the candidates beside them and numbers of other kinds.

Training takes at most ``TRAIN_TEXTS`` texts, the same number for each kind from
all that hold a find of it, and as many with other candidates and with none; of a
text over ``TRAIN_CHARS`` characters it takes pieces around its finds. Where a
kind has few finds, made-up ones are put into the texts, so the size of a table
and how rare a kind is do not switch it off. Candidates that may be hidden data
already teach nothing. Every find is disguised several times and judged by trees
that did not see its text. Every text is searched whole. A null text counts as
empty; without any text nothing is added.
Every row is searched on its own, repeated ones alike. Of overlapping
candidates the likelier stays, then the earlier; none overlaps a fixed find.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import on_executors, pieces, sample_order, written

KINDS = ("email", "ip", "card", "phone")
TRAIN_TEXTS = 2000
TRAIN_CHARS = 40_000
PRECISION = 0.98
_FOLDS = 4
_DISGUISES = 4  # of each find
_FINDS = (150, 500)  # of a kind in training: made-up ones are added up to the first, a sample is drawn above the second
_OTHERS = 4000  # candidates beside the finds in training, at most
_NEAR = 120  # characters around a find that its example keeps
_GROUPS = 6  # texts by kind, with other candidates, with none

Span = tuple[int, int]

_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_AT = re.compile(r"@|[(\[{] ?at ?[)\]}]| at ")
_WRITTEN_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot )[A-Za-z0-9-]{1,63}){1,6}")
_WRITTEN_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:(?: ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot )[A-Za-z0-9._%+-]{1,64}){0,3}\Z")
# The longest local part that the pattern takes, with the signs in it.
_LEAD = 4 * 64 + 3 * 7
_GENERATORS = (
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ ./_–-]{0,2}[0-9]){12,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])[(+]{0,2}[0-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])")),
)
_CUES = tuple(
    re.compile(p, re.I)
    for p in (
        r"mail|contact|kontakt|correo|courriel|write",
        r"\bip\b|host|server|addr|adres|client",
        r"card|visa|credit|karte|tarjeta|carte|account|konto|payment",
        r"tel|phone|fon|call|mobil|cell|fax|tél|appel|llam",
        r"version|\bv\.?\b|isbn|order|invoice|\bid\b|no\.|date|page|year|total|serial|ref",
    )
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> list[Span]:
    """Each at sign with the local part that runs up to it; what lies before the last match's end is used up."""
    out: list[Span] = []
    last = before = 0
    at = text.find("@")
    while at >= 0:
        part = text[max(last, before) : at]
        start = at - (len(part) - len(part.rstrip(_LOCAL)))
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            last = domain.end()
            out.append((start, last))
        before = at + 1
        at = text.find("@", before)
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """The finds of the fixed patterns, by kind."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    if _DIGIT.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        found["card"] = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)] if len(text) > 12 else []
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return found


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data; they may overlap each other and the fixed finds."""
    out = []
    for at in _AT.finditer(text):
        domain = _WRITTEN_DOMAIN.match(text, at.end())
        head = text[max(0, at.start() - _LEAD) : at.start()]
        local = _WRITTEN_LOCAL.search(head.rstrip(" ")) if domain else None
        if local:
            out.append(("email", at.start() - len(head) + local.start(), domain.end()))
    if _DIGIT.search(text):
        out += [(kind, *m.span()) for kind, pattern in _GENERATORS for m in pattern.finditer(text)]
    return out


def features(kind: str, start: int, end: int, text: str) -> list[float]:
    """Format and context of a candidate; the same for any kind."""
    span, before = text[start:end], text[max(0, start - 40) : start]
    groups = re.findall(r"[0-9]+", span)
    signs = re.sub(r"[A-Za-z0-9]", "", span)
    digits = "".join(groups)
    side = lambda c: 0.0 if not c or c.isspace() else 2.0 if c.isalnum() else 1.0
    return [
        *(float(kind == k) for k in KINDS),
        len(span),
        len(digits),
        sum(c.isalpha() for c in span),
        len(signs),
        len(set(signs)),
        len(groups),
        len(groups[0]) if groups else 0,
        len(groups[-1]) if groups else 0,
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        max((int(g[:4]) for g in groups), default=0),
        int(digits[0]) if digits else -1,
        float(bool(digits) and luhn(digits)),
        *(float(s in span) for s in ("+", "(", "@", "-", ".", "/", " ")),
        float(" at " in span),
        float(" dot " in span or "dot" in span),
        side(text[start - 1 : start]),
        side(text[end : end + 1]),
        *(float(len(cue.findall(before))) for cue in _CUES),
    ]


@dataclass
class Trees:
    """Boosted trees of fixed depth: each level asks one question a node, answers lead to leaves."""

    depth: int
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, cut, leaf

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += leaf[node - (2**self.depth - 1)]
        return out

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 16) -> Trees:
    """Logistic boosting with second-order gains over binned features."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(depth, float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    score = np.full(len(x), model.start)
    inner = 2**depth - 1
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            best, limit = 1e-6, bins + 1
            for f in range(x.shape[1]) if len(here) > 1 else ():
                gs = np.bincount(binned[here, f], g[here], bins + 1).cumsum()
                hs = np.bincount(binned[here, f], h[here], bins + 1).cumsum()
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                gain = gain[: len(cuts[f])]
                if len(gain) and gain.max() > best:
                    best, limit = gain.max(), int(gain.argmax())
                    feature[k], cut[k] = f, cuts[f][limit]
            node[here] = 2 * k + 1 + (binned[here, feature[k]] > limit)
        leaf = np.array([rate * g[node == k].sum() / (h[node == k].sum() + 1) for k in range(inner, 2 * inner + 1)])
        model.trees.append((feature, cut, leaf))
        score += leaf[node - inner]
    return model


@dataclass
class Model:
    trees: Trees | None
    thresholds: dict[str, float]  # above 1: none of this kind


def _disguised(kind: str, span: str, rng: random.Random) -> str:
    """A find as somebody might write it so that the fixed pattern misses it."""
    if kind == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), (" [at] ", ".")])
        return span.replace("@", at).replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", "(.)", " . ", ". "]))
    digits = _only_digits(span)
    if kind == "card":
        return rng.choice([".", "/", "--", "_", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, rest, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({area}) {rest}-{last}", f"{area}-{rest}-{last}", f"{area}.{rest}.{last}", f"00{digits[:-10]} {area} {rest} {last}", f"{area} {rest} {last}"])


def _missed(kind: str, span: str, rng: random.Random) -> tuple[str, str, str]:
    """A find that the fixed pattern misses, and what stands right before and after it.

    It is disguised, or a card number beside another number: the pattern takes
    both as one run of digits, which is too long for a card.
    """
    if kind != "card" or rng.random() < 0.7:
        return "", _disguised(kind, span, rng), ""
    while luhn(other := "".join(rng.choice("0123456789") for _ in range(rng.choice([12, 16, 16, 16, 19])))):
        pass
    digits = _only_digits(span)
    return (f"{other} ", digits, "") if rng.random() < 0.5 else ("", digits, f" {other}")


def _other_number(rng: random.Random) -> str:
    """Numbers and phrases that only look like personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    while luhn(wrong := d(16)):
        pass
    return rng.choice(
        [
            f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}",
            f"1{d(1)}.0{rng.randint(1, 9)}.20{d(2)} 1{d(1)}:{d(2)}",
            f"20{d(2)}-1{rng.randint(0, 2)}-2{rng.randint(0, 8)} 1{d(1)}:4{d(1)}:3{d(1)}",
            f"{rng.randint(1, 9)}.{d(1)}.{d(1)}",
            f"{rng.randint(1, 9)} {d(3)} {d(3)}.{d(2)}",
            f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
            wrong,
            "-".join(wrong[i : i + 4] for i in range(0, 16, 4)),
            ".".join(wrong[i : i + 4] for i in range(0, 16, 4)),
            d(rng.randint(7, 15)),
            f"{rng.randint(300, 999)}.{d(3)}.{d(3)}.{d(3)}",
            f"{d(5)}-{d(5)}",
            f"{d(3)}.{d(4)}/{d(5)}",
        ]
    )


def _other_phrase(rng: random.Random) -> str:
    """Phrases that only look like a written-out address."""
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    return rng.choice(
        [
            f"{word()} at {word()}.{word()}",
            f"{word()} at {rng.randint(1, 23)}.{rng.randint(10, 59)}",
            f"{rng.randint(1, 99)} @ {rng.randint(1, 99)}.{rng.randint(10, 99)}",
            f"{word()} at {word()}.{rng.choice(['com', 'org', 'net', 'de'])}",
            f"{word()} @ {word()}.{word()}",
        ]
    )


def _made_up(kind: str, rng: random.Random) -> str:
    """A find of the fixed patterns that stands in no text."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    if kind == "email":
        local = rng.choice([word(), f"{word()}.{word()}", f"{word()}{d(2)}", f"{word()}.{d(2)}", f"{word()}_{word()}"])
        return f"{local}@{word()}{rng.choice(['', d(1)])}.{rng.choice(['com', 'org', 'net', 'de', 'co.uk', 'example.com'])}"
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        while not luhn(digits := f"{rng.randint(3, 6)}{d(rng.choice([14, 15, 15, 15]))}"):
            pass
        return digits
    return f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}"


_GROUPED_PHONE = re.compile(r"(?:00[0-9]{1,3} ?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-]?[0-9]{4}\Z")


def _hidden(kind: str, span: str) -> bool:
    """Whether a candidate turns into a find when its disguise is undone."""
    if kind == "email":
        plain = re.sub(r" ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot ", ".", re.sub(r" ?[(\[{] ?at ?[)\]}] ?| at ", "@", span))
    elif kind == "ip":
        plain = re.sub(r"[^0-9.]", "", span)
    elif kind == "card":
        plain = _only_digits(span)
    else:
        return bool(_GROUPED_PHONE.match(span))
    return base_spans(plain)[kind] == [(0, len(plain))]


def _other_examples(text: str, found: dict[str, list[Span]]) -> list[tuple[list[float], int]]:
    """Candidates of a text that are no finds, not even hidden ones."""
    taken = _reach(sorted(s for spans in found.values() for s in spans))
    return [(features(k, s, e, text), 0) for k, s, e in candidates(text) if not _meets(s, e, *taken) and not _hidden(k, text[s:e])]


def _find_examples(kind: str, before: str, span: str, after: str, rng: random.Random) -> list[tuple[list[float], int]]:
    """Candidates where a find stood: the find in several disguises, and what only looks like one."""
    out = []
    for _ in range(_DISGUISES):
        other = _other_phrase(rng) if kind == "email" and rng.random() < 0.5 else _other_number(rng)
        for label, (left, written, right) in ((1, _missed(kind, span, rng)), (0, ("", other, ""))):
            text = before + left + written + right + after
            start = len(before) + len(left)
            end = start + len(written)
            for k, s, e in candidates(text):
                whole = (s, e) == (start, end) if left or right else s <= start and e >= end
                if s < end and start < e and (not label or (k == kind and whole)):
                    out.append((features(k, s, e, text), label))
    return out


def train(texts: list[str], seed: int = 17) -> Model:
    if not texts:
        return Model(None, {})
    rng = random.Random(seed)
    others: list[tuple[int, list[float], int]] = []
    finds: dict[str, list[tuple[int, str, str, str]]] = {kind: [] for kind in KINDS}
    for i, text in enumerate(texts):
        found = base_spans(text)
        others += [(i % _FOLDS, *example) for example in _other_examples(text, found)]
        for kind, spans in found.items():
            finds[kind] += [(i % _FOLDS, text[max(0, s - _NEAR) : s], text[s:e], text[e : e + _NEAR]) for s, e in rng.sample(spans, min(20, len(spans)))]
    rows = rng.sample(others, min(_OTHERS, len(others)))
    for kind, some in finds.items():
        for n in range(_FINDS[0] - len(some)):
            text = rng.choice(texts)
            at = text.find(" ", rng.randint(0, len(text)))
            at = len(text) if at < 0 else at
            some.append((n % _FOLDS, f"{text[max(0, at - _NEAR) : at]} ", _made_up(kind, rng), text[at : at + _NEAR]))
        for fold, before, span, after in rng.sample(some, min(_FINDS[1], len(some))):
            rows += [(fold, *example) for example in _find_examples(kind, before, span, after, rng)]
    x = np.array([r[1] for r in rows], float)
    y = np.array([r[2] for r in rows], float)
    fold = np.array([r[0] for r in rows])
    chance = np.zeros(len(rows))
    for f in range(_FOLDS):
        chance[fold == f] = boost(x[fold != f], y[fold != f]).chance(x[fold == f])
    thresholds = {}
    for i, kind in enumerate(KINDS):
        own = x[:, i] > 0
        p, truth = chance[own], y[own]
        order = np.argsort(-p, kind="stable")
        right, n = np.cumsum(truth[order]), np.arange(1, len(p) + 1)
        # One more error than seen, so that few finds never look precise.
        good = np.flatnonzero((right / (n + 1) >= PRECISION) & (np.append(p[order][1:], -1) < p[order]))
        thresholds[kind] = max(0.5, float(p[order][good[-1]])) if len(good) else 2.0
    return Model(boost(x, y), thresholds)


def added_spans(model: Model, text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """The candidates that the model selects beside the fixed finds."""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if model.trees is None or not (some := candidates(text)):
        return out
    taken = _reach(sorted(s for spans in base.values() for s in spans))
    free = [c for c in some if not _meets(c[1], c[2], *taken)]
    if not free:
        return out
    chance = model.trees.chance(np.array([features(k, s, e, text) for k, s, e in free], float))
    starts: list[int] = []
    ends: list[int] = []  # of spans that do not overlap, so in order as well
    for p, start, kind, end in sorted((-p, s, k, e) for p, (k, s, e) in zip(chance, free, strict=True) if p >= model.thresholds[k]):
        if not _meets(start, end, starts, ends):
            out[kind].append((start, end))
            insort(starts, start)
            insort(ends, end)
    return {kind: sorted(spans) for kind, spans in out.items()}


def _reach(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Where sorted spans begin, and how far they and all before them reach."""
    return [s for s, _ in spans], list(accumulate((e for _, e in spans), max))


def _meets(start: int, end: int, starts: list[int], reach: list[int]) -> bool:
    """Whether any of the spans overlaps: of those that begin before the end, one reaches beyond the start."""
    i = bisect_left(starts, end)
    return i > 0 and reach[i - 1] > start


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def _groups(text: str) -> int:
    """The groups a text belongs to as bits: the kinds it has finds of, else whether it has other candidates."""
    found = base_spans(text)
    bits = sum(1 << i for i, kind in enumerate(KINDS) if found[kind])
    return bits or 1 << len(KINDS) + (not candidates(text))


def excerpts(text: str, n_chars: int = TRAIN_CHARS) -> list[str]:
    """The text, or of a longer one pieces around a find of each kind and a candidate, cut at white space."""
    if len(text) <= n_chars:
        return [text]
    found = base_spans(text)
    centres = {spans[len(spans) // 2][0] for spans in found.values() if spans}
    centres |= {s for _, s, _ in candidates(text)[:1]} or {len(text) // 2}
    half = n_chars // (2 * _GROUPS)
    out = []
    for at in sorted(centres):
        start, end = max(0, at - half), min(len(text), at + half)
        piece = text[start:end]
        head = piece.find(" ", 0, half // 2) + 1 if start else 0
        tail = piece.rfind(" ", len(piece) - half // 2) if end < len(text) else -1
        out.append(piece[head : tail if tail > 0 else len(piece)])
    return out


def fit(docs: DataFrame, n_texts: int = TRAIN_TEXTS, n_chars: int = TRAIN_CHARS) -> Model:
    """Train on a bounded sample of the texts of each group; which those are is found over all documents."""
    texts = docs.select(sample_order("text").alias("key"), "text").where(F.length("text") > 0)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            bits = [_groups(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int32())], ["key", "bits"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            parts = [part for text in batch.column(0).to_pylist() for part in excerpts(text, n_chars)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], ["text"])

    known = written(texts.mapInArrow(judged, "key long, bits int").distinct(), "personal-data-groups")
    picked = [
        known.where(F.col("bits").bitwiseAND(F.lit(1 << g)) != 0).select("key").orderBy("key").limit(max(1, n_texts // _GROUPS))
        for g in range(_GROUPS)
    ]
    keys = F.broadcast(reduce(DataFrame.union, picked).distinct())
    # One row of a text, however often it is repeated; the cut comes after the join, so it sees few texts.
    rows = texts.join(keys, "key").select("text").mapInArrow(cut, "text string").distinct().collect()
    return train(sorted(r["text"] for r in rows))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, base, spans) of every row; both are lists kind:start:end."""
    load = on_executors(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in pieces(batches, 1):
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = added_spans(m, text or "", base)
                counts.append([len(base[k]) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined({k: sorted(base[k] + more[k]) for k in KINDS}))
            numbers = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in numbers), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def redacted(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, of the first one's kind."""
    out, last = [], 0
    for start, end, kind in sorted((s, e, k) for k, found in spans.items() for s, e in found):
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join(out) + text[last:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with personal data replaced in ``text``; a column n_chars follows. Null texts stay null."""
    load = on_executors(docs.sparkSession, model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load()
        for batch in pieces(batches, at):
            texts = []
            for text in batch.column(at).to_pylist():
                if text:
                    base = base_spans(text)
                    more = added_spans(m, text, base)
                    text = redacted(text, {k: base[k] + more[k] for k in KINDS})
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    changed = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
