"""Toxicity: a gap-weighted subsequence-kernel support vector machine.

Texts are cut into sentences, sentences into words.  Two words are compared by
the string kernel that counts common subsequences of ``LENGTH`` letters, each gap
letter costing a factor ``DECAY``; it is normalised, so an insult written with
letters put between, or spelt apart, stays close to its plain form.  The kernel is
approximated by Nyström landmarks; a linear SVM on the landmark features is
trained on the sentences of labelled documents, in rounds: first every word
stands for its sentence's label, then only the most telling words do, as judged by
a machine trained on the other half of the documents.
A second machine of the same kind compares windows of neighbouring words of a sentence,
the spaces as letters, for abuse whose words are ordinary ones.  A form or window is toxic
by its share among toxic documents against that among clean ones.
A sentence scores as its worst word or window, a document as its worst sentence, turned
into a probability by a logistic fit.

As the kernel is a sum over subsequences and the SVM is linear in the landmark
features, the trained machine is one weight per subsequence: scoring a word is a
sum over its subsequences, divided by its norm.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import small_batches, table, text_blocks, tidy
from stratus.llm.labels import held_out, sample

#: Labelled documents learnt from at most, and the longest of them in characters.
TRAIN_ROWS = 3000
TRAIN_CHARS = 40_000
#: Word forms of either label that a round of training adds at most.
TRAIN_WORDS = 3000
ROUNDS = 2
#: A form's weight is the number of documents it speaks for to this power.
POWER = 1.5
RIDGE = 0.1
BIAS = -1.0
LANDMARKS = 256
#: Words in a window.
WINDOWS = (2, 3)
#: A form is telling as far as its share among toxic documents exceeds so many times its share among clean ones.
DOUBT = 4.0
LENGTH = 3
DECAY = 0.6
#: The largest distance of neighbouring letters of a subsequence.
REACH = 4
#: Longer words are compared in pieces of so many letters, each overlapping the next by half.
PIECE = 32
THRESHOLD = 0.3

_SENTENCE = re.compile(r"[.!?\n]+(?:\s+|$)|\n")
_APART = re.compile(r"(?<!\S)(?:[^\W\d_]\s+){2,}[^\W\d_](?!\S)")
# Digits, signs and letters of other scripts that look like a letter.
_LEET = str.maketrans("013457@$аеорсухіѕјοıß", "oieastasaeopcyxisjois")
_SIZE = 32 ** LENGTH
_WEIGHTS = DECAY ** (np.arange(16) + 1.0)
_GAPS = [(i, j) for i in range(1, REACH + 1) for j in range(1, REACH + 1)]
# Codes of the kernel's alphabet: 1-26 small letters, 27 an accent, 28 and 29 the ends of a word, 30 a space; other signs are only gaps.
_CODES = np.zeros(128, np.uint8)
_CODES[97:123] = np.arange(1, 27)
_CODES[[39, 94, 36, 32]] = (27, 28, 29, 30)


def _hashed(c: str) -> str:
    """A letter outside a-z in the kernel's alphabet; an ideograph, which holds more than a letter does, as two."""
    h = ord(c) * 2654435761 % (1 << 32) >> 12
    return chr(97 + h % 26) + (chr(97 + h // 26 % 26) if _IDEOGRAPH.match(c) else "")


class _Alphabet(dict):
    """Signs after compatibility decomposition -> the kernel's alphabet, filled as signs are met."""

    def __missing__(self, at: int) -> str:
        c = chr(at)
        if "a" <= c <= "z":
            out = c
        elif unicodedata.combining(c):
            out = "'"
        else:  # vowel signs that are no accents are letters too
            out = _hashed(c) if unicodedata.category(c)[0] in "LM" else "_"
        self[at] = out
        return out


_ALPHABET = _Alphabet()
_IDEOGRAPH = re.compile("[\u2e80-\u2fdf\u3005-\u3007\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
# Scripts written without spaces between words: ideographs, kana, Thai, Lao, Burmese, Khmer.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def letters(word: str) -> str:
    """A word in the kernel's alphabet: small letters, ``'`` after a letter with an accent, ``_`` for any other sign.

    Look-alikes become the letter they stand for; letters of other scripts are hashed to small letters.
    """
    if word.isascii():
        word = word.lower().translate(_LEET)
        return word if word.isalpha() else "".join(c if c.isalpha() else "_" for c in word).strip("_")
    return unicodedata.normalize("NFKD", word.lower().translate(_LEET)).lower().translate(_LEET).translate(_ALPHABET).strip("_")


def forms_of(token: str) -> list[str]:
    """The forms of a word that are compared: itself between end marks, or overlapping pieces if it is long.

    A word of fewer than ``LENGTH`` letters, look-alikes counted, has none.  Where words are not
    set apart by spaces, every two and three neighbouring letters are taken for a word.
    """
    if not token.isascii() and _UNSPACED.search(token):
        at = [i for i, c in enumerate(token) if c.isalpha()]
        parts = {token[at[i]:at[i + n - 1] + 1] for n in (2, 3) for i in range(len(at) - n + 1)}
        return [f for part in sorted(parts) for f in _forms(letters(part))]
    return _forms(letters(token))


def _forms(w: str) -> list[str]:
    if len(w) - w.count("_") - w.count("'") < LENGTH:
        return []
    if len(w) <= PIECE:
        return [f"^{w}$"]
    return [w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)]


def tokens(text: str) -> set[str]:
    """The distinct words of a text; three or more single letters in a row also count as one word spelt apart."""
    out = set(text.split())
    out.update("".join(m[0].split()) for m in _APART.finditer(text))
    return out


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def subsequences(forms: list[str], apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(form, code, weight)``: the summed decay weight of every subsequence of each form, normalised per form.

    ``apart``: by the norm that counts a repeated subsequence apart, which sums along a text.
    """
    width = max((len(w) for w in forms), default=0)
    raw = b"".join(w.encode("ascii", "replace").ljust(width + 2 * REACH, b"\0") for w in forms)
    c = _CODES[np.frombuffer(raw, np.uint8).reshape(len(forms), width + 2 * REACH) & 127].astype(np.int64)
    start = (np.arange(len(forms), dtype=np.int64) << 19)[:, None] + (c << 14)
    keys = []
    for i, j in _GAPS:
        a, b, d = c[:, :width], c[:, i:i + width], c[:, i + j:i + j + width]
        key = start[:, :width] + (b << 9) + (d << 4) + (i + j)
        keys.append(key[(a > 0) & (b > 0) & (d > 0)])
    keys = np.sort(np.concatenate(keys))
    both = keys >> 4
    edges = np.flatnonzero(np.append(True, both[1:] != both[:-1])[:len(both)])
    if not len(edges):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    total = np.add.reduceat(_WEIGHTS[keys & 15], edges)
    form, code = both[edges] >> 15, both[edges] & (_SIZE - 1)
    each = _WEIGHTS[keys & 15] if apart else total
    norm = np.sqrt(np.bincount(keys >> 19 if apart else form, each * each, len(forms)))
    return form, code, total / norm[form]


def gram(x: list[str], y: list[str], step: int = 128, apart: bool = False) -> np.ndarray:
    """Normalised kernel of all forms of ``x`` with all of ``y``, ``step`` rows at a time to bound memory."""
    form, code, weight = subsequences(y, apart)
    columns = np.zeros((_SIZE, len(y)), np.float32)
    columns[code, form] = weight
    out = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, len(x), step):
        form, code, weight = subsequences(x[at:at + step], apart)
        edges = np.flatnonzero(np.append(True, form[1:] != form[:-1])[:len(form)])
        if len(edges):
            out[at + form[edges]] = np.add.reduceat(columns[code] * weight[:, None].astype(np.float32), edges)
    return out


def disguised(form: str, rng: np.random.Generator) -> str:
    """A form with a letter or sign put in at one or every inner place of its word."""
    word = form.strip("^$")
    extra = "_" if rng.random() < 0.5 else chr(97 + rng.integers(26))
    at = int(rng.integers(1, len(word)))
    return "^" + (extra.join(word) if rng.random() < 0.5 else word[:at] + extra + word[at:]) + "$"


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Linear SVM with weighted squared hinge loss by Newton steps.

    The bias is fixed at ``BIAS``: a word like no landmark is as clean as a word can be.
    """
    keep = np.full(x.shape[1], ridge)
    w = np.zeros(x.shape[1])

    def loss(w):
        return keep @ (w * w) / 2 + weight @ np.maximum(0, 1 - y * (x @ w + BIAS)) ** 2 / 2

    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ w + BIAS))
        inside = x[gap > 0]
        grad = keep * w - x.T @ (weight * y * gap)
        step = np.linalg.solve((inside.T * weight[gap > 0]) @ inside + np.diag(keep), grad)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-4:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Machine:
    """Weights of the subsequences, the bias, the logistic fit of document scores, and the windows' weights if there are any."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float, windows: np.ndarray | None = None):
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset
        self.windows, self.spelled = windows, {}

    def word_scores(self, forms: list[str]) -> np.ndarray:
        form, code, weight = subsequences(forms)
        return np.bincount(form, self.weights[code] * weight, len(forms)) + self.bias

    def score_all(self, forms: list[str], step: int = 1 << 10) -> dict[str, float]:
        parts = [forms[i:i + step] for i in range(0, len(forms), step)]
        return {w: v for p in parts for w, v in zip(p, self.word_scores(p).tolist())}

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _inside(margins) + self.offset, -30, 30)))


def _inside(margins: np.ndarray) -> np.ndarray:
    """Margins cut to -1..1.5: beyond, the machine is sure, and how far beyond says nothing."""
    return np.clip(margins, -1, 1.5)


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the probability of ``y`` given ``x``, where ``y`` holds in ``share`` of all cases."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    each = np.where(y > 0, share / pos, (1 - share) / neg) * len(y)
    x = _inside(x)

    def loss(c):
        z = c[0] * x + c[1]
        return each @ (np.logaddexp(0, z) - target * z) + 1e-3 * c[0] ** 2 / 2

    c = np.array([1.0, 0.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(c[0] * x + c[1], -30, 30)))
        r, s = each * (p - target), each * p * (1 - p) + 1e-9
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        step, size, now = np.linalg.solve(h, np.array([(r * x).sum() + 1e-3 * c[0], r.sum()])), 1.0, loss(c)
        while loss(c - size * step) > now and size > 1e-6:
            size /= 2
        c = c - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(max(1e-3, c[0])), float(c[1])


def windows_of(texts: list[str], spelled: dict[str, str], piece: int = 4096, most: int = 1 << 17
               ) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """``(signs, text, start, end)``: the windows of all sentences as places in a row of signs, some sentences at a time.

    A window is ``WINDOWS`` words between spaces, or as many more as make it longer than a subsequence.
    ``spelled`` remembers the letters of words.
    """
    lines, owner, size = [], [], 0

    def laid() -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        signs = ("_" * 2 * REACH).join(["", *lines, ""]).encode()
        space = np.flatnonzero(np.frombuffer(signs, np.uint8) == 32)
        count = np.array([x.count(" ") for x in lines])
        last, whose = np.repeat(np.cumsum(count) - 1, count), np.repeat(owner, count)
        at, enough = np.arange(len(space)), np.searchsorted(space, space + 2 * REACH - 1)
        found = []
        for n in WINDOWS:
            k = at[at + n <= last]
            found.append((k, np.minimum(np.maximum(k + n, enough[k]), last[k])))
        k, e = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(k, kind="stable")
        return signs, whose[k[order]], space[k[order]], space[e[order]] + 1

    for i, text in enumerate(texts):
        for s in sentences(text):
            words = []
            for t in s.split():
                w = spelled.get(t)
                if w is None:
                    w = spelled[t] = letters(t)
                if w:
                    words.append(w)
            for at in range(0, len(words) - 1, piece):
                lines.append(f" {' '.join(words[at:at + piece + 2 * REACH])} ")
                owner.append(i)
                size += len(lines[-1])
                if size > most:
                    yield laid()
                    lines, owner, size = [], [], 0
    if lines:
        yield laid()


def window_scores(signs: bytes, start: np.ndarray, end: np.ndarray, weights: np.ndarray, bias: float = BIAS) -> np.ndarray:
    """Scores of the windows: sums along the signs of all subsequences that begin, less those that end, in them."""
    c = _CODES[np.frombuffer(signs, np.uint8) & 127].astype(np.int32)
    n, far = len(c), 2 * REACH
    c = np.concatenate([c, np.zeros(far, np.int32)])
    high, middle = c[:n] << 10, c << 5
    table = weights.astype(np.float32)
    begun, ended = np.zeros(n + far), np.zeros(n + far)
    for i in range(1, REACH + 1):
        pair = high + middle[i:i + n]
        for j in range(1, REACH + 1):
            value = table[pair + c[i + j:i + j + n]] * np.float32(_WEIGHTS[i + j])
            begun[:n] += value
            ended[i + j:i + j + n] += value
    held, square = (c > 0).astype(float), DECAY ** 2

    def reach(x: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros(len(x))
        for i in range(1, REACH + 1):
            if step > 0:
                out[:-i] += square ** i * x[i:]
            else:
                out[i:] += square ** i * x[:-i]
        return out

    norms = [square * held * reach(held * reach(held, step), step) for step in (1, -1)]

    def inside(begun: np.ndarray, ended: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(ended))[end] - np.append(0, np.cumsum(begun))[start]

    return inside(begun, ended) / np.sqrt(np.maximum(inside(*norms), 1e-9)) + bias


def window_margins(texts: list[str], weights: np.ndarray, spelled: dict[str, str], bias: float = BIAS) -> np.ndarray:
    """The worst window's score of each text."""
    out = np.full(len(texts), bias)
    for signs, owner, start, end in windows_of(texts, spelled):
        if len(owner):
            score = window_scores(signs, start, end, weights, bias)
            edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[owner[edges]] = np.maximum(out[owner[edges]], np.maximum.reduceat(score, edges))
    return out


def _landmarks(telling: list[str], clean: list[str], apart: bool = False) -> list[str]:
    """Half telling words, each unlike those before it, half words of clean documents."""
    marks: list[str] = []
    near = gram(telling, telling, apart=apart)
    covered = np.zeros(len(near))
    for i, w in enumerate(telling):
        if len(marks) < LANDMARKS // 2 and covered[i] < 0.8:
            marks.append(w)
            covered = np.maximum(covered, near[:, i])
    known = set(marks)
    return marks + [w for w in clean if w not in known][:LANDMARKS - len(marks)]


def _learner(marks: list[str], apart: bool = False):
    """A function of toxic and clean cases, with their weights -> weights of the subsequences."""
    values, vectors = np.linalg.eigh(gram(marks, marks, apart=apart))
    keep = values > 1e-4
    whiten = vectors[:, keep] / np.sqrt(values[keep])

    def solve(bad: dict[str, float], good: dict[str, float]) -> np.ndarray:
        table = np.zeros(_SIZE)
        if not bad:
            return table
        x = gram(list(bad) + list(good), marks, apart=apart) @ whiten
        sign = np.repeat([1.0, -1.0], [len(bad), len(good)])
        weight, other = np.array(list(bad.values())), np.array(list(good.values()))
        each = np.concatenate([weight / weight.sum(), other / max(1, len(good))]) * len(x) / 2
        w = _svm(x, sign, each)
        form, code, value = subsequences(marks, apart)
        np.add.at(table, code, value * (whiten @ w)[form])
        return table

    return solve


def _telling(toxic: np.ndarray, clean: np.ndarray, toxic_rows: int, clean_rows: int) -> np.ndarray:
    """How telling forms are, 0 to 1, that so many of the toxic and clean documents hold; clean counts by their upper estimate."""
    share = (clean + np.sqrt(clean)) / max(1, clean_rows) * toxic_rows / np.maximum(1, toxic)
    return np.where(toxic > 0, np.maximum(0, 1 - DOUBT * share), 0)


def _learn_windows(toxic: list[str], clean: list[str], words: Machine, rng: np.random.Generator) -> np.ndarray | None:
    """Weights of the windows' machine; none where no window without a toxic word is surely more frequent in toxic documents."""
    spelled: dict[str, str] = {}

    def hashes(text: str) -> np.ndarray:
        return np.unique(np.array([hash(signs[a:b]) for signs, _, start, end in windows_of([text], spelled)
                                   for a, b in zip(start.tolist(), end.tolist())], np.int64))

    found, held = np.unique(np.concatenate([hashes(t) for t in toxic] or [np.zeros(0, np.int64)]), return_counts=True)
    found, held = found[held > 2], held[held > 2].astype(float)
    if not len(found):
        return None
    other = np.zeros(len(found))
    for t in clean:
        own = hashes(t)
        at = np.minimum(np.searchsorted(found, own), len(found) - 1)
        other[at[found[at] == own]] += 1
    telling, share = _telling(held, other, len(toxic), len(clean)), len(toxic) / (len(toxic) + len(clean))
    # Of so many windows some are in toxic documents only by chance; the counts must be less likely than one in all of them.
    total = held + other
    sure = held * np.log(held / total / share) + other * np.log(np.maximum(other, 1e-9) / total / (1 - share)) > np.log(len(found)) + 3
    rank = {int(found[i]): (held[i], telling[i]) for i in np.flatnonzero(sure & (telling > 0))}
    texts: dict[str, tuple[float, float]] = {}
    for t in toxic if rank else ():
        for signs, _, start, end in windows_of([t], spelled):
            for a, b in zip(start.tolist(), end.tolist()):
                if (h := hash(signs[a:b])) in rank:
                    texts[signs[a:b].decode()] = rank[h]
    # Windows with a word that is toxic by itself are known by it.
    forms = {w: _forms(w) for x in texts for w in x.split()}
    value = words.score_all(sorted({f for fs in forms.values() for f in fs}))
    texts = {x: v for x, v in texts.items() if all(value[f] < 0 for w in x.split() for f in forms[w])}
    if not texts:
        return None
    order = sorted(texts, key=lambda x: (-texts[x][0] * texts[x][1], x))[:TRAIN_WORDS]
    bad = {x: float(texts[x][0]) ** POWER * texts[x][1] for x in order}
    good: dict[str, float] = {}
    for t in clean:
        for signs, _, start, end in windows_of([t], spelled):
            for k in rng.integers(0, len(start), 1 + TRAIN_WORDS // len(clean)) if len(start) else ():
                good[signs[start[k]:end[k]].decode()] = 1.0
    good = {x: 1.0 for x in good if x not in texts}
    solve = _learner(_landmarks(order[:500], list(good), True), True)
    weights = solve(bad, good)
    for _ in range(ROUNDS + 1):  # the clean cases grow by the clean documents' worst
        worst = {}
        for signs, owner, start, end in windows_of(clean, spelled):
            score = window_scores(signs, start, end, weights)
            for k in np.argsort(-score)[:200]:
                worst[signs[start[k]:end[k]].decode()] = float(score[k])
        for x in sorted(worst, key=lambda x: (-worst[x], x))[:TRAIN_WORDS]:
            if x not in texts and worst[x] > -0.7:
                good[x] = 1.0
        weights = solve(bad, good)
    return weights


def train(rows: list[tuple[str, int]], share: float, seed: int = 9) -> Machine:
    """The machine learnt from labelled texts, ``share`` of all being toxic; with one label or none, a constant."""
    y = np.array([label for _, label in rows], int)
    if len(set(y.tolist())) < 2:
        return Machine(np.zeros(_SIZE), 0.0, 0.0, -4.0 if not y.sum() else 4.0)
    rng = np.random.default_rng(seed)
    known: dict[str, list[str]] = {}
    bags = []  # the forms of a document's labelled sentences
    for text, _ in rows:
        own = set()
        for s in sentences(text):
            for t in tokens(s):
                if t not in known:
                    known[t] = forms_of(t)
                own.update(known[t])
        bags.append(sorted(own))
    # Every fourth document of either label is kept for the logistic fit, so it is not fitted on margins that were trained on.
    fit = np.zeros(len(y), bool)
    for label in (0, 1):
        fit[np.flatnonzero(y == label)[3::4]] = True
    if not (fit & (y == 1)).any() or not (fit & (y == 0)).any():
        fit[:] = True
        learn = fit
    else:
        learn = ~fit
    seen = [Counter(), Counter()]  # documents of either label that hold a form
    for own, label, used in zip(bags, y, learn):
        if used:
            seen[label].update(own)
    forms, rows_of = sorted(seen[0].keys() | seen[1].keys()), [int((learn & (y == v)).sum()) for v in (0, 1)]
    both = [np.array([n[w] for w in forms], float) for n in seen]
    told = dict(zip(forms, _telling(both[1], both[0], rows_of[1], rows_of[0]).tolist()))
    toxic = [own for own, label, used in zip(bags, y, learn) if label and used]
    toxic = [sorted(w for w in own if told[w] > 0) for own in toxic]  # what clean documents hold as often is no insult
    halves = [toxic[::2], toxic[1::2]]
    # First round: every form of a toxic document's sentences is a case, by the number of documents that hold it.
    counts = [Counter(w for own in half for w in own) for half in halves]
    telling = sorted((w for w in forms if told[w] > 0), key=lambda w: (-seen[1][w] * told[w], w))[:TRAIN_WORDS]
    clean = sorted(seen[0], key=lambda w: (-seen[0][w], w))
    learner = _learner(_landmarks(telling[:500], clean[:TRAIN_WORDS]))

    def solve(bad: dict[str, float], good: list[str]) -> Machine:
        return Machine(learner(bad, {w: 1 - told[w] for w in good}), BIAS, 1.0, 0.0)

    def cases(count: Counter) -> dict[str, float]:
        most = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:TRAIN_WORDS]
        return {w: float(n) ** POWER * told[w] for w, n in most}

    good = clean[:TRAIN_WORDS]
    machines = [solve(cases(c), good) for c in counts]
    for _ in range(ROUNDS):
        # A toxic document's cases are now its worst forms, judged by the machine that has not seen its half, so that
        # forms found in that document only do not count; the clean cases grow by the clean documents' worst.
        for h in (0, 1):
            value = machines[1 - h].score_all(sorted({w for own in halves[h] for w in own}))
            counts[h] = Counter(w for own in halves[h] for w in sorted(own, key=lambda w: (-value[w], w))[:3] if value[w] > -0.5)
        hard = [m.score_all(clean) for m in machines]
        worst = sorted(clean, key=lambda w: (-max(hard[0][w], hard[1][w]), w))[:TRAIN_WORDS]
        good = list(dict.fromkeys(good + worst))
        machines = [solve(cases(c), good) for c in counts]
    bad = cases(counts[0] + counts[1])
    for w in list(bad):
        bad.setdefault(disguised(w, rng), 0.2 * bad[w])
    machine = solve(bad, good)
    machine.windows = _learn_windows(*([t for (t, _), v, used in zip(rows, y, learn) if used and v == k] for k in (1, 0)), machine, rng)
    kept = [own for own, f in zip(bags, fit) if f]
    value = machine.score_all(sorted(set().union(*kept)))
    margins = np.array([max((value[w] for w in own), default=machine.bias) for own in kept])
    if machine.windows is not None:
        margins = np.maximum(margins, window_margins([t for (t, _), f in zip(rows, fit) if f], machine.windows, {}))
    machine.slope, machine.offset = _logistic(margins, y[fit], share)
    return machine


def document_margins(texts: list[bytes], machine: Machine, known: dict[str, float]) -> np.ndarray:
    """The worst word's or window's score of each text (so its worst sentence's); without words, that of no subsequence.

    ``known`` remembers the scores of words.
    """
    plain = [t.decode("utf-8", "replace") for t in texts]
    split = [tokens(t) for t in plain]
    new = list(set().union(*split) - known.keys())
    for at in range(0, len(new), 1 << 10):
        part = new[at:at + (1 << 10)]
        forms = [forms_of(t) for t in part]
        flat = [f for fs in forms for f in fs]
        scores = iter(machine.word_scores(flat).tolist())
        for t, fs in zip(part, forms):
            known[t] = max((next(scores) for _ in fs), default=machine.bias)
    margins = np.array([max(map(known.__getitem__, d), default=machine.bias) for d in split])
    if machine.windows is None:
        return margins
    if len(machine.spelled) > 100_000:
        machine.spelled.clear()
    return np.maximum(margins, window_margins(plain, machine.windows, machine.spelled, machine.bias))


def scorer(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = TRAIN_ROWS):
    """A column function text -> probability, learnt from the labelled documents that are not held out."""
    small_batches(docs)
    learnt = train(*sample(docs, labels, label, train_rows, TRAIN_CHARS, balanced=True))
    model = docs.sparkSession.sparkContext.broadcast((learnt.weights, learnt.bias, learnt.slope, learnt.offset, learnt.windows))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine, known = Machine(*model.value), {}
        for batch in batches:
            out = []
            for _, block in text_blocks(batch, 2 << 20):
                if len(known) > 100_000:  # scores are remembered, not needed: forgetting costs only time
                    known.clear()
                out.append(machine.probability(document_margins(block, machine, known)))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return F.arrow_udf(tidy(run), "double", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    A null text, or one without a word of ``LENGTH`` letters, scores as a text
    without any subsequence.  Without labels, or with labels of one kind only,
    the score is constant.  Rows stand alone, so repeats and null ids need no
    care; a null doc_id is not held out, and never learnt from.  Columns besides
    doc_id and text are not read.
    """
    score = scorer(docs, labels, label, train_rows)
    out = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score(docs["text"]).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns as they are."""
    score = scorer(docs, labels)
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    return docs.select(row, score(docs["text"]).alias("score")).filter(F.col("score") < threshold).select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
