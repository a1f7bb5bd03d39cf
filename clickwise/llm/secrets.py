"""Secret scans: pattern findings, and a random forest that removes the false ones.

Three scanners with wide patterns (long runs of key characters with a digit; key prefixes; values of any length assigned to a
name that tells, quoted or up to the next space) yield findings; overlapping ones are merged. Each is described by its length, the rates of change between character classes, its entropy, the share
of it that dictionary words cover, the path (source) it was found in and its neighbouring words. A forest
trained on labelled findings gives the probability that it is a secret.

Labels: findings labelled by hand can be passed in (``labels``: value, secret). Without them, the labels are the
strict formats (fixed-prefix keys, a long mixed value assigned to a telling name) against findings that have another
reading (a payment card, telephone number or address, a date, plain digits, a word).  At most ``fit_rows`` findings
of each class, drawn by a seeded hash, are fitted on. If one class is missing there is no forest: the label decides, and a finding without one has a null probability and is no secret.

Null texts count as empty; empty texts have no findings. Repeated rows are scanned each for themselves. Findings that overlap are
merged; a probability of exactly 0.5 is a secret. A run of fewer than ``MIN_LENGTH`` (12) characters is a finding only behind a key prefix or a telling
name. A very long text is scanned whole. An empty table gives no
rows. Only the id, path and text columns are read. Offsets count code points.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zlib import crc32

from clickwise.llm.common import SEED, scratch_table, small_batches, text_key
from clickwise.llm.pii import luhn
from clickwise.llm.tokens import vocabulary as default_vocabulary

FIT_ROWS = 4000
TREES = 24
DEPTH = 6
THRESHOLD = 0.5

# fixed values: names that tell of a secret, and prefixes of public key formats
TELLING = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "auth", "credential", "private_key")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "xoxb-", "xoxp-", "AIza")

_PREFIXED = re.compile(f"(?:{'|'.join(map(re.escape, PREFIXES))})[A-Za-z0-9_/+=.-]+")
# name, sign, value; possessive and anchored at the name's start, so that long runs are read once
_ASSIGNED = re.compile(r"(?<![A-Za-z0-9_])([A-Za-z0-9_]++)[\"']?\s*+(?:=>|:=|[:=])\s*+")
_TELLS = re.compile("|".join(TELLING), re.IGNORECASE)
_QUOTED = re.compile(r"\"([^\"\n]+)\"|'([^'\n]+)'")
_BARE = re.compile(r"(?:(?![&;,]\s?[A-Za-z_]+\s?[:=])[^\s\"'])+")  # ends before a next assignment
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_HAS_DIGIT = re.compile(r"[0-9]")
_KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/+=.-")
_NAME = re.compile(r"([A-Za-z0-9_]+)[\"']?\s*(?:=>|:=|[:=])\s*[\"']?\Z")
MIN_LENGTH = 12

FEATURES = ["length", "digits", "upper", "lower", "signs", "hex_only", "entropy", "up_low", "low_up", "let_dig", "dig_let", "same",
            "covered", "name_tells", "quoted", "assigned", "word_before", "word_after", "path"]

_dictionaries: dict[str, frozenset] = {}


def dictionary(path: str | None = None) -> frozenset:
    """Whole words of at least four letters in a public vocabulary file."""
    path = path or default_vocabulary()
    if path not in _dictionaries:
        with open(path, encoding="utf-8") as f:
            words = json.load(f)["model"]["vocab"]
        _dictionaries[path] = frozenset(w[:-4] for w in words if w.endswith("</w>") and len(w) > 7 and w[:-4].isalpha())
    return _dictionaries[path]


def prefixed(text: str) -> Iterator[tuple[int, int]]:
    """Key prefixes and the key characters after them."""
    for m in _PREFIXED.finditer(text):
        e = m.start() + len(m.group().rstrip(".=-/"))
        if e > m.start():
            yield m.start(), e


def assigned(text: str) -> Iterator[tuple[int, int]]:
    """Values assigned to a telling name, of any length and with any characters."""
    end = 0
    for m in _ASSIGNED.finditer(text):
        s = m.end()
        if s < end or not _TELLS.search(m.group(1)):
            continue
        if q := _QUOTED.match(text, s):
            s, e = q.span(q.lastindex)
        else:
            s += text[s:s + 1] in ("\"", "'")  # an opening quote without its end
            v = _BARE.match(text, s)
            e = s + len(v.group().rstrip(".,;:)]}>")) if v else s
        if e > s:
            yield s, e
            end = e


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """The findings of all scanners in order; those that overlap are one."""
    start = end = -1
    for s, e in sorted([*runs(text), *prefixed(text), *assigned(text)]):
        if s < end:
            end = max(end, e)
            continue
        if end > 0:
            yield start, end
        start, end = s, e
    if end > 0:
        yield start, end


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Long runs of key characters with a digit, found from their digits (linear in long runs)."""
    end = 0
    for m in _HAS_DIGIT.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = at
        while start > end and text[start - 1] in _KEY_CHARS:
            start -= 1
        end = at + 1
        while end < len(text) and text[end] in _KEY_CHARS:
            end += 1
        s, e = start, end
        if (cut := text.rfind("=", s, at)) >= 0 and text[s:cut].strip("=").replace("_", "").isalpha():
            s = cut + 1  # name=value: the value
        while e > s and text[e - 1] in ".=-/":
            e -= 1
        if e - s >= MIN_LENGTH:
            yield s, e


def _covered(value: str, words: frozenset) -> float:
    letters, i, low = 0, 0, value.lower()
    while i < len(low):
        step = next((k for k in range(min(12, len(low) - i), 3, -1) if low[i:i + k] in words), 0)
        letters += step
        i += step or 1
    return letters / max(1, len(value))


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def describe(text: str, s: int, e: int, path: str, words: frozenset) -> list[float]:
    v = text[s:e]
    n = len(v)
    kinds = [_kind(c) for c in v]
    pairs = Counter(zip(kinds, kinds[1:]))
    m = max(1, n - 1)
    name = _NAME.search(text[max(0, s - 40):s])
    before, after = re.findall(r"\w+", text[max(0, s - 30):s]), re.findall(r"\w+", text[e:e + 30])
    bucket = lambda w: crc32(w.lower().encode()) % 32 / 32.0
    return [float(n), kinds.count(0) / n, kinds.count(1) / n, kinds.count(2) / n, kinds.count(3) / n,
            float(all(c in "0123456789abcdef" for c in v.lower())), -sum(k / n * math.log2(k / n) for k in Counter(v).values()),
            pairs[1, 2] / m, pairs[2, 1] / m, (pairs[1, 0] + pairs[2, 0]) / m, (pairs[0, 1] + pairs[0, 2]) / m,
            sum(a == b for a, b in zip(v, v[1:])) / m, _covered(v, words),
            float(bool(name) and any(t in name.group(1).lower() for t in TELLING)), float(text[s - 1:s] in "\"'" and s > 0), float(bool(name)),
            bucket(before[-1]) if before else -1.0, bucket(after[0]) if after else -1.0, bucket(path)]


def weak_label(text: str, s: int, e: int, words: frozenset = frozenset()) -> int | None:
    """1: a strict format; 0: it has another reading; null: neither."""
    v = text[s:e]
    if v.isalpha() and v.lower() in words:
        return 0
    if any(v.startswith(p) and len(v) >= len(p) + 12 and v[len(p):].isalnum() for p in PREFIXES):
        return 1
    name = _NAME.search(text[max(0, s - 40):s])
    mixed = any(c.isdigit() for c in v) and any(c.isalpha() for c in v)
    if name and any(t in name.group(1).lower() for t in TELLING) and mixed and len(v) >= MIN_LENGTH and "." not in v and not re.search(r"\s", v):
        return 1
    digits = re.sub(r"[^0-9]", "", v)
    if not any(c.isalpha() for c in v) and (len(digits) < 14 or luhn(digits) or "." in v or "-" in v):
        return 0
    if "@" in text[max(0, s - 1):s] + text[e:e + 1] or _ADDRESS.fullmatch(v) or re.fullmatch(r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}", v):
        return 0
    if not any(c.isalpha() for c in v):
        return 0
    return None


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()),
                     ("weak", pa.int32()), *[(f, pa.float64()) for f in FEATURES]])
_DDL = "doc_id long, key long, start long, end long, value string, weak int, " + ", ".join(f"{f} double" for f in FEATURES)


def findings(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
             path_col: str = "source") -> DataFrame:
    """Every finding of the scanner with its description."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(vocabulary)
        for b in batches:
            rows = []
            for d, k, path, t in zip(*[c.to_pylist() for c in b.columns]):
                for s, e in candidates(t) if t else ():
                    rows.append((d, k, s, e, t[s:e], weak_label(t, s, e, words), *describe(t, s, e, path or "", words)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_SCHEMA), _SCHEMA)],
                                             schema=_SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("key"),
                       F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text")).mapInArrow(scan, _DDL)


def score_findings(found: DataFrame, labels: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The findings (stored) with ``probability`` and ``secret``."""
    if labels is not None:
        known = found.join(labels.select("value", F.col("secret").cast("int").alias("label")).distinct(), "value")
    else:
        known = found.where("weak IS NOT NULL").withColumn("label", F.col("weak"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if min(n1, n0) == 0:
        label = F.col("weak")
        if labels is not None:
            given = labels.groupBy("value").agg(F.max(F.col("secret").cast("int")).alias("_given"))
            found, label = found.join(given, "value", "left"), F.col("_given")
        scored = found.withColumn("probability", label.cast("double")).drop("_given")
        return scored.withColumn("secret", F.coalesce(F.col("probability") >= THRESHOLD, F.lit(False)))
    pick = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "start", "value"), F.lit(1 << 30)) < F.when(
        F.col("label") == 1, int((1 << 30) * min(1.0, fit_rows / n1))).otherwise(int((1 << 30) * min(1.0, fit_rows / n0)))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="described",
                                    featureSubsetStrategy="sqrt")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="described")
    sample = scratch_table(known.where(pick).select(F.col("label").cast("double"), *FEATURES).repartition(1)
                           .sortWithinPartitions("label", *FEATURES), "findings-sample")
    model = Pipeline(stages=[assembler, forest]).fit(sample)
    scored = model.transform(found).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(*found.columns, F.col("_p").alias("probability"), (F.col("_p") >= THRESHOLD).alias("secret"))


def scan_rows(docs: DataFrame, labels: DataFrame | None = None, fit_rows: int = FIT_ROWS, vocabulary: str | None = None,
              id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per document: doc_id, n_findings, n_secrets, spans ("start:end" of the secrets, comma-joined)."""
    found = scratch_table(findings(docs, vocabulary, id_col, text_col, path_col), "findings")
    scored = score_findings(found, labels, fit_rows)
    # repeated rows (same id and text) have the same findings: each counts once
    per_doc = scored.groupBy("doc_id", "key").agg(
        F.count_distinct("start").alias("n_findings"), F.count_distinct(F.when(F.col("secret"), F.col("start"))).alias("n_secrets"),
        F.array_sort(F.collect_set(F.when(F.col("secret"), F.struct("start", "end")))).alias("_spans"))
    text = F.transform("_spans", lambda x: F.concat(x["start"], F.lit(":"), x["end"]))
    found_in = per_doc.select(F.col("doc_id").alias("_id"), "key", "n_findings", "n_secrets", F.array_join(text, ",").alias("_text"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("_key"))
    out = rows.join(found_in, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("key")), "left")
    return out.select("doc_id", F.coalesce("n_findings", F.lit(0)).cast("long").alias("n_findings"),
                      F.coalesce("n_secrets", F.lit(0)).cast("long").alias("n_secrets"), F.coalesce("_text", F.lit("")).alias("spans"))
