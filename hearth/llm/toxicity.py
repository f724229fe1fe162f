"""Toxicity by a subsequence string kernel and a Nyström support vector machine.

The kernel of two words is the inner product of their gapped subsequences of
three characters: a subsequence that spans m characters counts ``DECAY ** m``,
up to ``SPAN`` characters, so ``i.d.i.o.t`` or ``idxiot`` still shares most of
the weight of ``idiot``.  A word starts and ends with a mark, case and accents
count as they are seen (lower case), digits and signs that stand for letters
are read as those.  Letters that signs keep apart are also read as one word
without the signs: single letters in a row across any signs and spaces
(``i d i o t``, ``i - d - i - o - t``), and what any signs cut within a word
(``i|d|i|o|t``, ``id(iot``, ``i--d--i--o--t``), in stretches of ``JOINED``
letters that overlap by half, so no length is left out.  Words are normed by the kernel with themselves (coinciding
subsequences apart).

Training takes a bounded, deterministic sample of labelled sentences' documents
(``SAMPLE`` of each label, smallest hashes of doc_id first, while their texts fit
``SAMPLE_CHARS``; only training folds).  A document is a bag of words of
which a toxic one has at least one toxic: words of toxic documents that clean
documents hold clearly less often open as positives, the others are
negatives; Nyström features against ``LANDMARKS`` landmark words feed a linear
machine with squared hinge loss, and the bags' witnesses are chosen anew by the
machine in each of a few rounds.  Bags are made in tasks; each document's distinct words come to the driver, which
fits the machine (its size does not grow with the corpus).  A document's margin is its best word's; a
logistic fit on the training bags makes it a score.

The machine's function is ``sum_j b_j k(x, landmark_j)``, and as the kernel's
feature map is finite the sum over landmarks is one table of weights by
subsequence.  Scoring reads every character of every whole text against that
table with numpy (``mapInArrow``), so its cost does not depend on the number of
landmarks.

Defined cases: null and empty texts have no word and get the score of the
lowest margin; documents without a label only get a score; null labels are not
used; without both labels every score is 0; repeated rows are kept; texts of any length are
read whole; documents whose margin ties get one score, and a score of 0.5 is toxic; other
columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import give_back, id_text, rows_of, ship

#: Labelled documents of each label that training takes at most, and their characters in all.
SAMPLE, SAMPLE_CHARS = 2_500, 24_000_000
LANDMARKS = 256
DECAY, SPAN = 0.75, 6
ROUNDS = 6
#: Words of the sample that the machine is fitted on at most: witnesses to begin with and later, negatives that are frequent, rare and
#: (in all) near the cut.  The bound is on the rows of one linear system; every word of the sample is judged in every round.
WITNESSES, MORE_WITNESSES, FREQUENT_WORDS, RARE_WORDS, NEAR_WORDS, NEGATIVES = 1_500, 2_500, 2_500, 3_500, 4_000, 12_000
#: Words whose feature maps are held at once; the character that stands for class 0 where words are strings.
PART, BASE = 500, 0x40
#: Folds by crc32 of the id's text: the fold that is never trained on.
FOLDS, HELD_OUT = 5, 0
#: Characters are told apart in this many classes; signs in words keep classes of their own.
CLASSES = 64
_LIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "!"})
#: Letters of a joined word; longer ones are read in stretches.
JOINED = 40
#: Letters kept apart by signs: single ones also across spaces, and within a word short pieces alone and all pieces.
_APART = [
    re.compile(p)
    for p in (
        r"(?<![^\W_])[^\W_](?:[\W_]++[^\W_](?![^\W_])){2,}+",
        r"(?<![^\W_])[^\W_]{1,3}(?:(?:_|[^\w\s])++[^\W_]{1,3}(?![^\W_]))++",
        r"(?<![^\W_])[^\W_]++(?:(?:_|[^\w\s])++[^\W_]++)++",
    )
]
_SIGNS = re.compile(r"[\W_]+")
_GAPS = [(g, h) for g in range(1, SPAN) for h in range(1, SPAN) if g + h < SPAN]


def _classes() -> np.ndarray:
    """Class of a code point: 0 ends words (space, sentence marks), letters have their own, the rest share."""
    t = np.zeros(0x3000, dtype=np.int32)
    for c in range(0x3000):
        ch = chr(c)
        t[c] = 1 + c % (CLASSES - 1)
        if ch.isspace() or ch in ",;:!?\"()[]{}|" or c < 32:
            t[c] = 0
    for i, ch in enumerate("abcdefghijklmnopqrstuvwxyz"):
        t[ord(ch)] = 1 + i
    t[ord(".")] = 0
    for i, ch in enumerate("äöüßàâçèéêëîïôùûñáíóú"):
        t[ord(ch)] = 27 + i
    for i, ch in enumerate("-_*'&%#/+0123456789"):
        t[ord(ch)] = 48 + i % 15
    return t


_CLASS = _classes()


def joined(lowered: str) -> list[str]:
    """Words that signs keep apart, without the signs; each once."""
    out: dict[str, None] = {}
    cut = " ".join(w for w in lowered.split() if not w.isalnum())  # only these can hold a sign
    for apart, where in zip(_APART, (lowered, cut, cut)):
        for found in apart.findall(where):
            w = _SIGNS.sub("", found)
            for at in range(0, max(len(w) - JOINED // 2, 1), JOINED // 2):
                out[w[at : at + JOINED]] = None
    return list(out)


def codes(text: str) -> np.ndarray:
    """Character classes of a text with one word end on both sides; words that signs keep apart come once more, joined."""
    lowered = text.lower().translate(_LIKE)
    lowered = f" {' '.join([lowered, *joined(lowered)])} "
    c = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(c < len(_CLASS), _CLASS[np.minimum(c, len(_CLASS) - 1)], 1 + c % (CLASSES - 1)).astype(np.int64)


def subsequences(c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: places of the first character, subsequence numbers, weight.
    A word end may be the first or last character, never inside."""
    ends = np.cumsum(c == 0)
    n = len(c)
    for g, h in _GAPS:
        m = n - g - h
        if m <= 0:
            continue
        a, b, d = c[:m], c[g : g + m], c[g + h :]
        inner = ends[g + h - 1 : n - 1] - ends[:m]  # word ends strictly between
        at = np.flatnonzero((inner == 0) & ((a > 0) | (d > 0)))
        yield at, (a[at] * CLASSES + b[at]) * CLASSES + d[at], DECAY ** (g + h + 1)


def words_of(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number of each place (a word end belongs to the word after it) and the first place of each word."""
    starts = np.flatnonzero((c[:-1] == 0) & (c[1:] != 0))
    return np.maximum(np.cumsum(np.r_[(c[:-1] == 0) & (c[1:] != 0), False]) - 1, 0), starts


def word_margins(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel machine value, without the intercept, of every word."""
    number, starts = words_of(c)
    if not len(starts):
        return np.zeros(0)
    total, norm = np.zeros(len(starts)), np.zeros(len(starts))
    for at, which, weight in subsequences(c):
        total += np.bincount(number[at], weights=table[which] * weight, minlength=len(starts))
        norm += np.bincount(number[at], minlength=len(starts)) * weight**2
    return total / np.sqrt(np.maximum(norm, 1e-12))


@dataclass
class Machine:
    table: np.ndarray
    intercept: float
    scale: float

    def margin(self, text: str) -> float:
        m = word_margins(codes(text), self.table)
        return float(m.max()) + self.intercept if len(m) else -10.0

    def score(self, text: str) -> float:
        if self.scale == 0:
            return 0.0
        z = self.scale * self.margin(text)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _features(words: list[str]) -> list[dict[int, float]]:
    """The explicit normed feature map of single words."""
    out = []
    for w in words:
        f: Counter = Counter()
        norm = 0.0
        for _, which, weight in subsequences(np.r_[0, _word_codes(w), 0]):
            norm += len(which) * weight**2
            for x in which.tolist():
                f[x] += weight
        s = max(norm, 1e-12) ** 0.5
        out.append({k: v / s for k, v in f.items()})
    return out


def _word_codes(w: str) -> np.ndarray:
    return np.array([ord(x) - BASE for x in w], dtype=np.int64)


def _bag(text: str) -> set[str]:
    """The text's words as strings of classes, one byte each."""
    c = codes(text)
    return set("".join(map(chr, (c + BASE).tolist())).split(chr(BASE))) - {""}


def _kernel(a: list[dict[int, float]], b: list[dict[int, float]]) -> np.ndarray:
    names = {k: i for i, k in enumerate({k for f in b for k in f})}
    dense = np.zeros((len(names), len(b)))
    for j, f in enumerate(b):
        for k, v in f.items():
            dense[names[k], j] = v
    out = np.zeros((len(a), len(b)))
    for i, f in enumerate(a):
        at = [(names[k], v) for k, v in f.items() if k in names]
        if at:
            rows, values = zip(*at)
            out[i] = np.array(values) @ dense[list(rows)]
    return out


def train(texts: list[str], labels: list[int]) -> Machine:
    """A machine from documents and their labels (1: toxic)."""
    return train_bags((_bag(t) for t in texts), labels)


def train_bags(words: Iterable[Iterable[str]], labels: list[int]) -> Machine:
    """A machine from the bags of words of documents and their labels."""
    one: dict[str, str] = {}  # each word's string is kept once, however many bags hold it
    bags = [tuple(sorted(one.setdefault(w, w) for w in b)) for b in words]  # sorted: the same machine in every run
    toxic = [b for b, y in zip(bags, labels) if y]
    clean = [b for b, y in zip(bags, labels) if not y]
    empty = Machine(np.zeros(CLASSES**3, dtype=np.float32), 0.0, 0.0)
    if not toxic or not clean:
        return empty
    in_toxic, in_clean = Counter(w for b in toxic for w in b), Counter(w for b in clean for w in b)
    rate = {w: (n / len(toxic)) - 2 * (in_clean[w] + 1) / len(clean) for w, n in in_toxic.items() if n >= 2}
    # a word's company: how often words with the same first characters point to toxic documents
    stems_t, stems_c = Counter(w[:4] for b in toxic for w in b), Counter(w[:4] for b in clean for w in b)
    lean = lambda w: (stems_t[w[:4]] + 0.1) / len(toxic) / ((stems_c[w[:4]] + 1) / len(clean))
    chosen: Counter = Counter()
    for b in toxic:  # witnesses to begin with: the word that points most clearly to toxic documents
        best = max(b, key=lambda w: (rate.get(w, 0) + 0.01 * np.log(lean(w)), w), default=None)
        if best is not None and (rate.get(best, 0) > 0 or lean(best) > 5):
            chosen[best] += 1
    # words that toxic documents hold often and clean ones (as good as) never count as witnesses throughout
    firm = [w for w, n in in_toxic.most_common() if n >= 5 and n * len(clean) >= 40 * (in_clean[w] + 0.2) * len(toxic)]
    positives = firm = list(dict.fromkeys(firm + [w for w, _ in chosen.most_common(WITNESSES)]))[:WITNESSES]
    common = [w for w, _ in in_clean.most_common(FREQUENT_WORDS)]
    rng = np.random.default_rng(7)
    rare = sorted(w for w in in_clean if in_clean[w] <= 3)
    negatives = list(dict.fromkeys(common + [rare[i] for i in rng.choice(len(rare), min(len(rare), RARE_WORDS), replace=False)]))
    if not positives:
        return empty
    half = LANDMARKS // 2
    landmarks = list(dict.fromkeys(positives[:half] + [negatives[i] for i in rng.choice(len(negatives), min(half, len(negatives)), replace=False)]))
    mark = _features(landmarks)
    values, vectors = np.linalg.eigh(_kernel(mark, mark) + 1e-6 * np.eye(len(mark)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # Nyström: k(x, landmarks) @ root

    def table_of(w: np.ndarray) -> np.ndarray:
        t = np.zeros(CLASSES**3, dtype=np.float32)
        for f, beta in zip(mark, root @ w):
            for k, v in f.items():
                t[k] += beta * v
        return t

    # the distinct words of the sample, laid out as rows of codes, and each bag as numbers of words
    vocabulary = sorted(set().union(*bags))
    number = {w: i for i, w in enumerate(vocabulary)}
    laid = [np.concatenate([np.r_[0, _word_codes(w)] for w in vocabulary[at : at + 8 * PART]] + [np.zeros(1, dtype=np.int64)]).astype(np.uint8) for at in range(0, len(vocabulary), 8 * PART)]
    numbers = [np.fromiter(map(number.__getitem__, bag), dtype=np.int32, count=len(bag)) for bag in bags]
    del bags, toxic, clean, number
    n_toxic, n_clean = sum(labels), len(labels) - sum(labels)
    y_doc = np.array(labels)
    known: dict[str, dict[int, float]] = {}
    machine, fewest = empty, len(labels) + 1
    for _ in range(ROUNDS):
        new = [w for w in positives + negatives if w not in known]
        for at in range(0, len(new), PART):  # feature maps of a part of the words at once
            known.update(zip(new[at : at + PART], _kernel(_features(new[at : at + PART]), mark) @ root))
        x = np.ones((len(positives) + len(negatives), root.shape[1] + 1))  # the last column stays: the intercept's
        for i, v in enumerate(positives + negatives):
            x[i, :-1] = known[v]
        y = np.r_[np.ones(len(positives)), -np.ones(len(negatives))]
        often = np.array([1.0 + in_toxic[w] for w in positives] + [1.0 + in_clean[w] ** 0.5 for w in negatives])  # a word counts by its documents
        weight = often * np.where(y > 0, 0.5 / often[y > 0].sum(), 0.5 / often[y < 0].sum())
        w, b = _squared_hinge(x, y, weight)
        del x
        table = table_of(w)
        margin = np.concatenate([word_margins(part.astype(np.int64), table) for part in laid]) + b
        best = np.array([margin[i].max() if len(i) else -10.0 for i in numbers])
        cut, scale, errors = _cut(best, y_doc)
        if errors <= fewest:  # the round with the fewest errors on the sample stays
            machine, fewest = Machine(table, b - cut, scale), errors
        # next round: new witnesses, and the clean words that come near the cut
        found = [vocabulary[i[margin[i].argmax()]] for i, t, m in zip(numbers, y_doc, best) if t and m > cut]
        positives = list(dict.fromkeys(firm + found))[:MORE_WITNESSES]
        positives = [p for p in positives if in_clean[p] * n_toxic < in_toxic[p] * n_clean * 0.5] or firm
        near = Counter(vocabulary[j] for i, t in zip(numbers, y_doc) if not t for j in i[margin[i] > cut - 0.7].tolist())
        held = set(positives)
        negatives = [v for v in dict.fromkeys([v for v, _ in near.most_common(NEAR_WORDS)] + negatives) if v not in held][:NEGATIVES]
    return machine


def _squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20_000.0) -> tuple[np.ndarray, float]:
    """Newton steps on ``|w|^2 / 2 + c * sum(weight * max(0, 1 - y f)^2)``; the last column of ``z`` is the intercept's, all ones."""
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(25):
        active = y * (z @ w) < 1
        za, wa = z[active], (2 * c * weight[active])[:, None]
        new = np.linalg.solve(ridge + za.T @ (wa * za), za.T @ (wa[:, 0] * y[active]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _cut(best: np.ndarray, labels: np.ndarray) -> tuple[float, float, int]:
    """Cut with the fewest errors (both labels weigh as they are; the middle of equal cuts), a scale of the margins, and those errors."""
    order = np.argsort(best)
    b, y = best[order], labels[order]
    errors = np.r_[0, np.cumsum(y)] + ((1 - y).sum() - np.r_[0, np.cumsum(1 - y)])
    low = np.flatnonzero(errors == errors.min())
    mids = np.r_[b[0] - 1, (b[1:] + b[:-1]) / 2, b[-1] + 1]
    widths = np.r_[0, np.diff(b), 0]
    at = low[np.argmax(widths[low])]
    return float(mids[at]), 6.0, int(errors.min())


def held_out(id_text_: str) -> bool:
    return zlib.crc32(id_text_.encode()) % FOLDS == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from the training folds of ``docs`` (``doc_id text``) and ``labels`` (``doc_id toxic``)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("y in (0, 1)").distinct()
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = known.where(fold != HELD_OUT)
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(SAMPLE) for y in (0, 1)]
    picked = id_text(docs).join(F.broadcast(parts[0].union(parts[1])), "doc_id").withColumn("o", order)  # at most 2 * SAMPLE rows of labels
    sizes = picked.select("o", "doc_id", F.xxhash64("text").alias("t"), F.length("text").alias("n")).distinct().orderBy("o", "t").toPandas()
    room, chosen = SAMPLE_CHARS, []
    for i, t, n in zip(sizes["doc_id"].tolist(), sizes["t"].tolist(), sizes["n"].tolist()):
        if n <= room:
            room -= n
            chosen.append((i, t))
    if not chosen:
        return train([], [])
    # as an Arrow table: rows of Python objects would start workers of their own, which stay beside those that score
    wanted = docs.sparkSession.createDataFrame(pa.table(list(map(list, zip(*chosen))), names=["doc_id", "t"]))
    rows = picked.withColumn("t", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "t"], "left_semi")
    rows = rows.select("y", "text", "o", "t").dropDuplicates(["o", "text", "y"])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            words = ["".join(sorted(chr(BASE) + w for w in _bag(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("o"), b.column("t"), b.column("y"), pa.array(words, type=pa.string())], ["o", "t", "y", "words"])

    # words, each once a document, come to the driver, not texts
    ship(docs.sparkSession)
    found = rows.mapInArrow(bags, "o long, t long, y int, words string").orderBy("o", "t", "y").toArrow()
    machine = train_bags((w.as_py().split(chr(BASE))[1:] for w in found.column("words")), found.column("y").to_pylist())
    del found
    give_back()
    return machine


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id held_out score predicted`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(machine)  # one table of CLASSES ** 3 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in rows_of(batches):
            ids = b.column("doc_id").to_pylist()
            scores = [m.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([i is not None and held_out(str(i)) for i in ids], type=pa.bool_()),
                    pa.array(scores, type=pa.float64()), pa.array([int(s >= 0.5) for s in scores], type=pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(machine)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            yield b.filter(pa.array([shared.value.score(t or "") < 0.5 for t in b.column(at).to_pylist()], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
