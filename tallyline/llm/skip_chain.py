"""Personal data by patterns and a skip-chain conditional random field.

Patterns find what they can (the base). The field then labels the tokens that could belong to an
entity, those with a digit or an ``@``; every other token is outside by definition. Neighbours
form a chain, and each occurrence of a token is linked to its next occurrence in the document,
compared without case and separators, however far away: repeated tokens share a potential, so a
telephone number that is complete once is also found where its prefix is missing. Numbers are
written in groups of any size, so runs of neighbouring number tokens are linked too, by their
joined digits: two runs of at least ``LEAST_DIGITS`` whose digits are equal, or one the end of
the other, link the tokens that share a digit, however either is grouped. Labels come
from loopy belief propagation, for all documents of a batch at once; base tokens are clamped.

The potentials are fitted piecewise from counts over all documents, summed by Spark: log odds of
a token's signature under the base labels, and log odds of label pairs along chain and skip
links. The base is a partial labelling: a repeat of one of its tokens that no pattern covers is
unknown, not outside, so a skip link with one end in the base and the other not is no evidence;
``agreement`` is the weight, in links, of the prior that repeats have one label.
What comes to the driver is bounded by the number of signatures kept.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = OUTSIDE + 1
MAX_SIGNATURES = 50_000
AGREEMENT = 10.0
#: Digits of a run of number tokens that can be linked: the fewest in any span of digits, and the most.
LEAST_DIGITS, MOST_DIGITS = 7, 19

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_possible = re.compile(r"[0-9@]").search
_token = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_beside = re.compile(r"[ ().-]{0,3}").fullmatch
_digits = re.compile(r"[^0-9]")
_form = re.compile(r"[^0-9a-z@]")
_number = re.compile(r"[0-9][0-9().-]*").fullmatch
_runs = re.compile(r"[0-9]+|[^\W\d_]+")
#: What a span of each kind cannot do without: its form, with the fewest digits in all.
_needs = (
    (re.compile(r"\S+@\S+\.\S+").fullmatch, 0),
    (re.compile(r"\d+(\.\d+){3}").fullmatch, 4),
    (re.compile(r"\d[\d -]+").fullmatch, 13),
    (re.compile(r"[\d(][\d() .-]+").fullmatch, 7),
)
_luhn_double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    back = [int(d) for d in reversed(digits)]
    return (sum(back[::2]) + sum(_luhn_double[d] for d in back[1::2])) % 10 == 0


def _digits_of(text: str) -> str:
    return _digits.sub("", text)


def _at_most_255(digits: str) -> bool:
    """Of a number of any length without leading zeros."""
    return len(digits) < 4 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all pattern matches by kind and start; a failing match is dropped."""
    found = []
    if not _possible(text):
        return found
    if "@" in text:
        found += [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(_at_most_255(p.lstrip("0")) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits_of(m[0])) <= 15]
    return found


class Numbers:
    """Runs of neighbouring number tokens of one text, by their joined digits."""

    def __init__(self, first: int) -> None:
        self.first = first  # of the text's tokens in the graph
        self.digits: list[str] = []  # of each token, empty if it is no number
        self.run = ""  # the last MOST_DIGITS digits of the run that ends here
        self.sizes: list[int] = []  # digits from each token of the run to its end, the nearest last
        self.whole: dict[str, int] = {}  # digits of a run of whole tokens: where it last ended
        self.ends: dict[str, int] = {}  # digits that end a run, from anywhere in a token: the same

    def linked(self, digits: str, beside: bool) -> list[tuple[int, int]]:
        """Add the next token; the links of the longest run ending in it that stood earlier."""
        me = len(self.digits)
        self.digits.append(digits)
        if not (digits and beside):
            self.run, self.sizes = "", []
        if not digits:
            return []
        self.run = (self.run + digits)[-MOST_DIGITS:]
        self.sizes = [s + len(digits) for s in (*self.sizes, 0) if s + len(digits) <= MOST_DIGITS]
        ends = [(n, self.run[-n:]) for n in range(len(self.run), LEAST_DIGITS - 1, -1)]
        found: list[tuple[int, int]] = []
        for n, end in ends:
            earlier = (self.ends if n in self.sizes else self.whole).get(end)
            if earlier is not None:
                found = self._pairs(earlier, me, n)
                if found:
                    break
        for n, end in ends:
            self.ends[end] = me
            if n in self.sizes:
                self.whole[end] = me
        return found

    def _pairs(self, a: int, b: int, n: int) -> list[tuple[int, int]]:
        """Tokens that share one of the last ``n`` digits of the runs ending in a and b; none if the runs overlap."""
        pairs, end = [], a
        left, right = len(self.digits[a]), len(self.digits[b])
        while True:
            if b <= end:
                return []
            pairs.append((self.first + a, self.first + b))
            step = min(left, right, n)
            left, right, n = left - step, right - step, n - step
            if not n:
                return pairs
            if not left:
                a -= 1
                left = len(self.digits[a])
            if not right:
                b -= 1
                right = len(self.digits[b])


@dataclass
class Graph:
    """Tokens of a batch of texts and the links between them."""

    doc: list[int] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    signatures: list[str] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)  # of the base, else OUTSIDE
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        last_of: dict[str, int] = {}
        numbers = Numbers(len(self.doc))
        links: set[tuple[int, int]] = set()
        covered = sorted((s, e, k) for k, s, e in base)
        at, previous = 0, None
        for m in _token.finditer(text):
            start, end = m.span()
            word = m[0]
            start += len(word) - len(word.lstrip("([{<\"'+,;:"))
            end -= len(word) - len(word.rstrip(".,;:!?)]}>\"'"))
            if end <= start:
                continue
            word = text[start:end]
            while at < len(covered) and covered[at][1] <= start:
                at += 1
            inside = [k for s, e, k in covered[at : at + 4] if s < end and start < e]
            me = len(self.doc)
            self.doc.append(doc)
            self.spans.append((start, end))
            self.labels.append(min(inside, default=OUTSIDE))
            self.signatures.append(signature(word))
            beside = previous is not None and _beside(text, self.spans[previous][1], start) is not None
            if beside:
                self.chain.append((previous, me))
            links.update(numbers.linked(_digits_of(word) if _number(word) else "", beside))
            form = _form.sub("", word.lower())
            if len(form) > 3:
                if form in last_of:
                    links.add((last_of[form], me))
                last_of[form] = me
            previous = me
        self.skip += sorted(links)


def signature(word: str) -> str:
    """Shape of a token: the length of each run of digits, letters as one, other marks as they are."""
    shape = _runs.sub(lambda m: str(min(len(m[0]), 20)) if m[0].isdigit() else "a", word[:200])
    digits = _digits_of(word[:200])
    return f"{shape[:40]}{'!' if 13 <= len(digits) <= 19 and luhn(digits) else ''}"


def graph_of(texts: list[str | None]) -> tuple[Graph, list[list[tuple[int, int, int]]]]:
    graph, bases = Graph(), []
    for i, text in enumerate(texts):
        base = base_spans(text or "")
        bases.append(base)
        if text and _possible(text):
            graph.add(i, text, base)
    return graph, bases


@dataclass(frozen=True)
class Potentials:
    """Log potentials: of each signature, for labels along the chain, and along skip links."""

    unary: dict[str, np.ndarray]
    other: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for at in range(0, batch.num_rows, 512):
            graph, _ = graph_of(batch.column("text").slice(at, 512).to_pylist())
            counts.update(("node", s, y) for s, y in zip(graph.signatures, graph.labels, strict=True))
            for kind, links in (("chain", graph.chain), ("skip", graph.skip)):
                pairs = ((graph.labels[a], graph.labels[b]) for a, b in links)
                counts.update((kind, str(a), b) for a, b in pairs if kind == "chain" or (a == OUTSIDE) == (b == OUTSIDE))
        if counts:
            part, value, label = zip(*counts, strict=True)
            columns = [pa.array(part), pa.array(value), pa.array(label, pa.int32()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "value", "label", "n"])


def fitted(docs: DataFrame, max_signatures: int = MAX_SIGNATURES, agreement: float = AGREEMENT) -> Potentials:
    """Potentials from all texts of ``docs``; signatures beyond the most frequent share one."""
    texts = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    counts = texts.mapInArrow(_counted, "part string, value string, label int, n long")
    counts = counts.groupBy("part", "value").pivot("label", list(range(LABELS))).agg(F.sum("n"))
    n = sum(F.coalesce(F.col(str(y)), F.lit(0)) for y in range(LABELS))
    rows = counts.withColumn("all", n).orderBy(F.expr("part = 'node'"), F.desc("all"), "value").limit(max_signatures).collect()
    total = np.ones(LABELS)
    pairs = {"chain": np.full((LABELS, LABELS), 0.5), "skip": 0.5 + agreement * np.eye(LABELS)}
    seen = {}
    for row in rows:
        by_label = np.array([row[str(y)] or 0 for y in range(LABELS)], dtype=float)
        if row["part"] == "node":
            seen[row["value"]] = by_label
            total += by_label
        else:
            pairs[row["part"]][int(row["value"])] += by_label
    prior = total / total.sum()
    unary = {s: np.log((c + prior) / (c.sum() + 1)) for s, c in seen.items()}
    chain, skip = (_odds(pairs[k]) for k in ("chain", "skip"))
    return Potentials(unary, np.log(prior), chain, skip)


def _odds(counts: np.ndarray) -> np.ndarray:
    """How much likelier each pair of labels is than by chance; links have no direction."""
    p = (counts + counts.T) / (2 * counts.sum())
    return np.log(p) - np.log(p.sum(axis=1))[:, None] - np.log(p.sum(axis=0))[None, :]


def marginals(graph: Graph, potentials: Potentials, rounds: int = 12, damping: float = 0.3) -> np.ndarray:
    """Probabilities of the labels of every token (one row each) by loopy belief propagation."""
    n = len(graph.doc)
    unary = np.array([potentials.unary.get(s, potentials.other) for s in graph.signatures]).reshape(n, LABELS)
    given = np.array(graph.labels, dtype=np.int64)
    known = np.flatnonzero(given != OUTSIDE)
    unary[known] = -50.0
    unary[known, given[known]] = 0.0
    links = np.array([*graph.chain, *graph.skip], dtype=np.int64).reshape(-1, 2)
    e = len(links)
    source, target = np.concatenate([links, links[:, ::-1]]).T if e else (np.empty(0, np.int64),) * 2
    pair = np.concatenate([np.repeat([potentials.chain], len(graph.chain), 0), np.repeat([potentials.skip], len(graph.skip), 0)]).reshape(e, LABELS, LABELS)
    pair = np.concatenate([pair, pair])
    back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
    message = np.zeros((2 * e, LABELS))
    belief = unary
    for _ in range(rounds if e else 0):
        cavity = belief[source] - message[back]
        fresh = _log_sum((cavity[:, :, None] + pair).transpose(0, 2, 1))
        fresh -= _log_sum(fresh)[:, None]
        message = damping * message + (1 - damping) * fresh
        belief = unary.copy()
        np.add.at(belief, target, message)
    return np.exp(belief - _log_sum(belief)[:, None]) if n else unary


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=-1, keepdims=True)))[..., 0]


def added_spans(texts: list[str | None], graph: Graph, potentials: Potentials, sure: float) -> dict[int, list]:
    """By document, (kind, start, end) of runs of neighbouring tokens that the field labels alike."""
    chance = marginals(graph, potentials)
    label = np.where(chance.max(axis=1) >= sure, chance.argmax(axis=1), OUTSIDE) if len(chance) else []
    beside = set(graph.chain)
    found: dict[int, list] = {}
    run: list[int] = []

    def close() -> None:
        if run:
            kind, doc = int(label[run[0]]), graph.doc[run[0]]
            start, end = graph.spans[run[0]][0], graph.spans[run[-1]][1]
            word = texts[doc][start:end]
            form, digits = _needs[kind]
            if form(word) and len(_digits_of(word)) >= digits:
                found.setdefault(doc, []).append((kind, start, end))

    for i, y in enumerate(label):
        if y == OUTSIDE or graph.labels[i] != OUTSIDE:
            close()
            run = []
        elif run and (run[-1], i) in beside and label[run[-1]] == y:
            run.append(i)
        else:
            close()
            run = [i]
    close()
    return found


def _spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


FOUND = T.StructType([
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType()),
])
SURE = 0.9


def _searching(shared, sure: float, finish, columns):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column("text").to_pylist()
                graph, bases = graph_of(texts)
                added = added_spans(texts, graph, shared.value, sure)
                yield finish(batch.select(columns), texts, bases, [added.get(i, []) for i in range(len(texts))])

    return search


def _described(batch: pa.RecordBatch, texts: list, bases: list, added: list) -> pa.RecordBatch:
    counts = [pa.array([sum(k == kind for k, _, _ in b) for b in bases], pa.int64()) for kind in range(len(KINDS))]
    digest = [hashlib.sha256(_spelled(b).encode()).hexdigest() for b in bases]
    spans = [_spelled([*b, *a]) for b, a in zip(bases, added, strict=True)]
    more = [pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array(list(map(len, added)), pa.int64())]
    return pa.RecordBatch.from_arrays([*batch.columns, *counts, *more], names=[*batch.schema.names, *FOUND.names])


def found_in(docs: DataFrame, potentials: Potentials, sure: float = SURE) -> DataFrame:
    """(doc_id, counts of base spans by kind, base_sha256, spans, n_added) of every row of ``docs``.

    Spans are code points, end exclusive, by kind as in KINDS and then start. A null or empty text
    has none. Rows are kept as they are, repeated ones and null ids too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(potentials)
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], *FOUND.fields])
    return docs.mapInArrow(_searching(shared, sure, _described, ["doc_id"]), schema)


def masked_text(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """``text`` with each span replaced by its kind; of overlapping ones the first and longest names it."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for start, stop, kind in sorted(((s, e, k) for k, s, e in spans), key=lambda x: (x[0], -x[1], x[2])):
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, stop)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, potentials: Potentials, sure: float = SURE) -> DataFrame:
    """``docs`` with all found spans of ``text`` masked; other columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(potentials)
    names = docs.columns
    place = names.index("text")

    def finish(batch: pa.RecordBatch, texts: list, bases: list, added: list) -> pa.RecordBatch:
        new = [masked_text(t, [*b, *a]) for t, b, a in zip(texts, bases, added, strict=True)]
        return batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    return docs.mapInArrow(_searching(shared, sure, finish, names), docs.schema)
