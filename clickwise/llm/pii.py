"""Personal data: pattern matches, and a semi-Markov conditional random field that adds to them.

The four base kinds are found by their patterns over the whole text. Around every digit, at-sign and "(at)" the text is cut
into units (runs of letters or digits, single signs); a segmentation of such a window is a sequence of
entities of at most ``MAX_UNITS`` units with a kind each, and single units outside. A segment is scored by
features of the whole span (digit groups, signs, checksum, neighbours); dynamic programming over the bounded
segments gives the partition function for training and the best segmentation for tagging. Entities that
overlap no base match are added.

Training: windows of at most ``fit_docs`` documents, drawn by a seeded hash from all that have any, labelled by the base
patterns, and the same windows with each match rewritten into another notation of its kind, or into
something else (dates, versions, prices, failed checksums) that is labelled as none.

Null texts count as empty; empty texts have no spans. Ties between segmentations go to the unit outside an entity, then the earliest start, then the
kinds as listed. A very long text is tagged whole, its windows decoded some units at a time. Repeated rows are tagged each for themselves. An empty table gives no
rows (and an untrained model, which adds nothing). Only the id and text columns are read. Offsets count code points.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import SEED, small_batches, text_key

KINDS = ("email", "ip", "card", "phone")
MAX_UNITS = 16
#: Characters around a hit that its window takes in.
REACH = 48
FIT_DOCS = 400
EPOCHS = 6
DIMENSIONS = 1 << 14

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match cannot start inside a run of digits (where it would fail at the run's start it fails inside too)
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HIT = re.compile(r"[0-9@]|[\[(]at[\])]")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|[^\s]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the at-signs (linear also in long runs of letters)."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the pattern matches, by start and kind."""
    out = []
    if "@" in text:
        out += [(s, e, 0) for s, e in _emails(text)]
    if _HIT.search(text):
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(int(g[-4:]) <= 255 and (len(g) < 4 or not g[:-3].strip("0")) for g in m.groups())]
        out += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2]))


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Units (start, end) around the hits; windows that meet are one."""
    hits = [m.start() for m in _HIT.finditer(text)]
    i = 0
    while i < len(hits):
        low = hits[i]
        high = low
        while i < len(hits) and hits[i] <= high + REACH:
            high = hits[i]
            i += 1
        start, stop = max(0, low - REACH), min(len(text), high + REACH)
        yield [m.span() for m in _UNIT.finditer(text, start, stop)]


def _features(text: str, units: list[tuple[int, int]], i: int, j: int) -> list[int] | None:
    """Hashed features of the span of the units i to j-1; None where no entity can be."""
    s, e = units[i][0], units[j - 1][1]
    span = text[s:e]
    if not (span[0].isalnum() or span[0] in "+(") or not (span[-1].isalnum()):
        return None
    groups = re.findall(r"[0-9]+", span)
    n = sum(map(len, groups))
    at = "@" in span or "(at)" in span or "[at]" in span
    if not at and n < 4:
        return None
    signs = "".join(sorted({c for c in span if not c.isalnum()}))
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 20)) + "d", span))
    left = text[s - 1] if s else "^"
    right = text[e] if e < len(text) else "$"
    near = lambda c: c if not c.isalnum() else "9" if c.isdigit() else "a"
    before = re.findall(r"[a-z]+", text[max(0, s - 24):s].lower())
    octets = len(groups) == 4 and all(int(g[:4]) <= 255 and len(g) < 4 for g in groups)
    found = ["bias", f"n{n}", f"g{len(groups)}", f"signs{signs}", f"shape{shape[:60]}", f"left{near(left)}", f"right{near(right)}",
             f"luhn{n > 12 and luhn(''.join(groups))}{13 < n < 20}", f"oct{octets}{span.count('.')}", f"at{at}{span.count('.')}{span[-1].isalpha()}",
             f"letters{any(c.isalpha() for c in span)}{at}", f"units{min(j - i, 20)}", f"word{before[-1] if before else ''}",
             f"ends{near(span[0])}{near(span[-1])}{min(n, 20)}", f"gr{'-'.join(str(min(len(g), 9)) for g in groups[:6])}",
             f"sp{' ' in span}{at}", f"right2{right}{near(text[e + 1]) if e + 1 < len(text) else '$'}{at}"]
    return [crc32(f.encode()) % DIMENSIONS for f in found]


def _segments(text: str, units: list[tuple[int, int]], start: int, stop: int) -> Iterator[tuple[int, int, list[int]]]:
    """(i, j, features) of the segments that begin at the units from ``start`` to ``stop`` - 1, by i, then j."""
    for i in range(start, stop):
        s = units[i][0]
        if not (text[s].isalnum() or text[s] in "+("):
            continue
        digits, at = 0, False
        for j in range(i + 1, min(i + MAX_UNITS, len(units)) + 1):
            a, e = units[j - 1]
            digits += (e - a) * text[a].isdecimal()
            at = at or text[a] == "@" or text[a:e] == "at"
            if not text[a].isalnum() or not at and (digits < 4 or text[s].isalpha() or text[a].isalpha()):
                continue
            if (f := _features(text, units, i, j)) is not None:
                yield i, j, f


#: Units whose segments are scored at once when a window is decoded.
DECODED_AT_ONCE = 64


def best_segments(text: str, units: list[tuple[int, int]], w: np.ndarray) -> list[tuple[int, int, int]]:
    """The entities (i, j, kind) of the best segmentation of a window, as :meth:`Lattice.best` has them, with memory for the features of
    some units at a time: each unit holds the best value so far and a pointer back."""
    n = len(units)
    value, top = np.zeros(n + 1), np.full(n + 1, -np.inf)  # best up to a unit; best of those that end in an entity there
    origin, kind = np.zeros(n + 1, np.int64), np.full(n + 1, -1, np.int64)
    for start in range(0, n, DECODED_AT_ONCE):
        stop = min(start + DECODED_AT_ONCE, n)
        found = list(_segments(text, units, start, stop))
        scores = w[np.array([f for _, _, f in found])].sum(axis=1) if found else np.zeros((0, len(KINDS)))
        at, kinds, best = 0, scores.argmax(axis=1), scores.max(axis=1, initial=-np.inf)
        for i in range(start, stop):
            if i:
                value[i] = value[i - 1]
                if top[i] > value[i]:
                    value[i] = top[i]
                else:
                    kind[i] = -1
            while at < len(found) and found[at][0] == i:
                j = found[at][1]
                if value[i] + best[at] > top[j]:
                    top[j], origin[j], kind[j] = value[i] + best[at], i, kinds[at]
                at += 1
    if n and not top[n] > value[n - 1]:
        kind[n] = -1
    out, j = [], n
    while j > 0:
        if kind[j] >= 0:
            out.append((int(origin[j]), j, int(kind[j])))
            j = int(origin[j])
        else:
            j -= 1
    return out[::-1]


class Lattice:
    """All segments of a window: ``where`` (i, j) and feature numbers."""

    def __init__(self, text: str, units: list[tuple[int, int]]):
        self.n, self.units, self.where, rows = len(units), units, [], []
        for i, j, f in _segments(text, units, 0, len(units)):
            self.where.append((i, j))
            rows.append(f)
        self.features = np.array(rows, np.int64).reshape(len(rows), len(rows[0]) if rows else 1)
        self.into: list[list[int]] = [[] for _ in range(self.n + 1)]
        for k, (_, j) in enumerate(self.where):
            self.into[j].append(k)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return w[self.features].sum(axis=1) if self.where else np.zeros((0, len(KINDS)))

    def best(self, w: np.ndarray) -> list[tuple[int, int, int]]:
        """The entities (i, j, kind) of the best segmentation; a unit outside scores 0."""
        s = self.scores(w)
        value, back = [0.0], [None]
        for j in range(1, self.n + 1):
            top, how = value[j - 1], None
            for k in self.into[j]:
                c = int(s[k].argmax())
                if value[self.where[k][0]] + s[k, c] > top:
                    top, how = value[self.where[k][0]] + s[k, c], (self.where[k][0], j, c)
            value.append(top)
            back.append(how)
        out, j = [], self.n
        while j > 0:
            if back[j]:
                out.append(back[j])
                j = back[j][0]
            else:
                j -= 1
        return out[::-1]

    def expected(self, w: np.ndarray) -> np.ndarray:
        """Probability of every (segment, kind) under the model, by forward and backward sums."""
        s = self.scores(w)
        total = np.logaddexp.reduce(s, axis=1) if len(s) else np.zeros(0)
        fwd, bwd = np.zeros(self.n + 1), np.full(self.n + 1, -np.inf)
        for j in range(1, self.n + 1):
            fwd[j] = np.logaddexp.reduce([fwd[j - 1], *[fwd[self.where[k][0]] + total[k] for k in self.into[j]]])
        bwd[self.n] = 0.0
        for j in range(self.n, 0, -1):
            bwd[j - 1] = np.logaddexp(bwd[j - 1], bwd[j])
            for k in self.into[j]:
                i = self.where[k][0]
                bwd[i] = np.logaddexp(bwd[i], bwd[j] + total[k])
        outer = np.array([fwd[i] + bwd[j] - fwd[self.n] for i, j in self.where])
        return np.exp(s + outer[:, None]) if len(s) else s


def _other_notation(kind: int, span: str, rng: random.Random) -> tuple[str, str]:
    """Another way to write the span: (what precedes the entity, entity)."""
    d = _digits(span)
    if kind == 0:
        name, _, host = span.partition("@")
        return "", rng.choice([f"{name} (at) {host}", f"{name}[at]{host}", f"{name} @ {host}", f"{name}(at){host}"])
    if kind == 1:
        return "", rng.choice([span.replace(".", "[.]"), span])
    if kind == 2:
        four = [d[i:i + 4] for i in range(0, len(d), 4)]
        return "", rng.choice([".".join(four), "/".join(four), " ".join(four), "-".join(four)])
    a, b, c = d[-10:-7], d[-7:-4], d[-4:]
    return "", rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}"])


def _something_else(rng: random.Random) -> str:
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    card = "4" + n(15)
    while luhn(card):
        card = "4" + n(15)
    return rng.choice([f"20{n(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/19{n(2)}",
                       f"v{rng.randint(1, 9)}.{n(2)}.{n(1)}", f"{rng.randint(1, 9)},{n(3)}.{n(2)}", n(5), n(7), n(9), card, n(13), n(24),
                       f"{rng.randint(300, 999)}.{n(3)}.{rng.randint(300, 999)}.{n(2)}", f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
                       "".join(rng.choice("0123456789abcdef") for _ in range(40)), "password=" + "".join(rng.choice("0123456789abcdef") for _ in range(18)),
                       "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"{n(4)}-{n(4)}", f"{n(3)}.{n(2)}%",
                       f"@{rng.choice(['home', 'user'])}{n(2)}", f"{n(1)}.{n(2)}.{n(3)}", f"+{n(3)}", f"ISBN {n(3)}-{n(1)}-{n(2)}-{n(6)}-{n(1)}"])


def examples(texts: list[str]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Training windows with their entities: as found, in another notation, and with something else instead."""
    rng, out = random.Random(SEED), []
    for text in texts:
        spans = []
        for s in base_spans(text):
            if not spans or s[0] >= spans[-1][1]:
                spans.append(s)
        out.append((text, spans))
        for how in (0, 1, 2):
            built, gold, at = "", [], 0
            for s, e, k in spans:
                built += text[at:s]
                entity = _something_else(rng) if how == 2 else _other_notation(k, text[s:e], rng)[1]
                if how < 2:
                    gold.append((len(built), len(built) + len(entity), k))
                built += entity
                at = e
            out.append((built + text[at:], gold))
    return out


def fit(texts: list[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Weights (features x kinds) of greatest likelihood by adaptive gradient steps; zero without examples."""
    w = np.zeros((DIMENSIONS, len(KINDS)))
    data = []
    for text, gold in examples(texts):
        for units in windows(text):
            lattice = Lattice(text, units)
            if not lattice.where:
                continue
            starts, ends = {s: i for i, (s, _) in enumerate(units)}, {e: i + 1 for i, (_, e) in enumerate(units)}
            truth = {(starts[s], ends[e]): k for s, e, k in gold if s in starts and e in ends}
            y = np.zeros((len(lattice.where), len(KINDS)))
            for i, ij in enumerate(lattice.where):
                if ij in truth:
                    y[i, truth[ij]] = 1.0
            data.append((lattice, y))
    seen = np.full(w.shape, 1e-6)
    order = random.Random(SEED)
    w[crc32(b"bias") % DIMENSIONS] = -1.0
    for _ in range(epochs):
        order.shuffle(data)
        for lattice, y in data:
            d = y - lattice.expected(w)
            flat = lattice.features
            rows, place = np.unique(flat, return_inverse=True)
            g = np.zeros((len(rows), len(KINDS)))
            np.add.at(g, place.ravel(), np.repeat(d, flat.shape[1], axis=0))
            gr = g - decay * w[rows]
            seen[rows] += gr ** 2
            w[rows] += rate * gr / np.sqrt(seen[rows])
    return w if data else np.zeros_like(w)


def all_spans(text: str, w: np.ndarray) -> tuple[list, list]:
    """(base spans, base and added spans), each by start and kind."""
    base = base_spans(text)
    added = []
    if w.any():
        for units in windows(text):
            for i, j, k in best_segments(text, units, w):
                s, e = units[i][0], units[j - 1][1]
                if all(e <= b[0] or s >= b[1] for b in base):
                    added.append((s, e, k))
    return base, sorted(base + added, key=lambda x: (x[0], x[2]))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind."""
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def train(docs: DataFrame, fit_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Fit on windows of at most ``fit_docs`` documents."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spans = base_spans(t)
                if spans:  # one window a document: the surroundings of its first match
                    s, e, _ = spans[0]
                    out.append({"h": h, "window": t[max(0, s - 100):e + 100]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("h", pa.int64()), ("window", pa.string())]))

    # every pattern needs a digit or an at-sign
    some = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.xxhash64(F.lit(SEED), F.col(id_col), text_key(F.col(text_col))).alias("h"),
                                                               F.col(text_col).alias("text"))
    sample = some.mapInArrow(cut, "h long, window string").orderBy("h", "window").limit(fit_docs).collect()
    return fit([r["window"] for r in sample])


def tag_rows(docs: DataFrame, fit_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text",
             with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (all), and with
    ``with_text`` the redacted text."""
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(train(docs, fit_docs, id_col, text_col))
    schema = pa.schema([("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS]
                       + [("base_sha256", pa.string()), ("spans", pa.string())] + [("redacted", pa.string())] * with_text)
    ddl = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
           + ", redacted string" * with_text)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in schema.names[1:]]
            for t in b.column(1).to_pylist():
                base, every = all_spans(t, weights.value) if t else ([], [])
                row = [sum(k == i for _, _, k in base) for i in range(len(KINDS))]
                row += [hashlib.sha256(written(base).encode()).hexdigest(), written(every)]
                for c, v in zip(cols, row + [redacted(t or "", every)] * with_text):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tag, ddl)
