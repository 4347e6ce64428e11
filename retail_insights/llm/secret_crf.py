"""Secret scanning: fixed base patterns and a linear-chain conditional random
field over tokens, decoded by Viterbi.

A token is a run of letters, digits, ``+ / _ . -`` and non-ASCII bytes.  It is
tagged outside (O), begin (B) or inside (I) of a secret from its own shape and
length, the character before it, the shapes and words of its neighbours, and
features of the whole text.  The model is trained by gradient descent on the
conditional likelihood of windows from a bounded sample of documents.  Their
labels are the values that the base patterns find, the same values rewritten
into forms that no base pattern finds (``REWRITES``), and, as the other side,
values of like shape that are no secrets (``LOOKALIKES``).  Base spans always
stay; decoded spans that overlap none of them are added as kind ``crf``.

Decoding is exact: a token whose score for O leads by more than any two
transitions can win back is O on every best path, so the text falls into
short stretches between such tokens, and Viterbi runs on each.

Prediction is one narrow pass.  Training sees ``SAMPLE_DOCS`` documents in
expectation, chosen by hash, and at most ``SAMPLE_WINDOWS`` windows of each of
four kinds.

Defined results: null and empty texts have no spans; repeated rows are judged
one by one; without a base span to learn from only base spans are found;
other columns (clashing names included) are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_insights.llm.common import only, positional, table

# Kinds in their order, and the base patterns.
KINDS = ["assign", "access", "hex", "crf"]
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_LENGTH = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

SAMPLE_DOCS, SAMPLE_WINDOWS = 20_000, 1_500
#: Tokens on either side of a training window's centre.
REACH = 6
EPOCHS, RATE, DECAY = 40, 0.5, 1e-3
#: Share of the hard training tokens outside secrets (long ones, or with digits) that calibration may give up.
FALSE_SHARE = 0.004
WORDS = 4096
HARD_LENGTH = 16
#: Times that a sampled text with base spans is rewritten.
VARIANTS = 6
#: Sizes of the features, see ``token_features``.
SIZES = [32, 64, 64, 8, WORDS, 64, 64, 16, 64, 32]
UNIT = 1 << 20
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in code points."""
    return [(k, a, b) for k, a, b, _ in _base(text)]


def _base(text: str) -> list[tuple[int, int, int, int]]:
    """Base spans with the place where the secret value starts."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII):
            if m.end(2) - m.start(2) >= MIN_LENGTH["assign"]:
                out.append((0, *m.span(), m.start(2)))
    if "AKIA" in text:
        out += [(1, *m.span(), m.start()) for m in re.finditer(ACCESS, text) if len(m.group()) >= MIN_LENGTH["access"]]
    # Runs of hexadecimal digits are maximal, so their least length can be part of the pattern.
    for m in re.finditer("(?<![0-9a-f])[0-9a-f]{%d,}" % MIN_LENGTH["hex"], text):
        out.append((2, *m.span(), m.start()))
    return out


class _Draw:
    """Characters drawn from a seed: the same text gives the same ones anywhere."""

    def __init__(self, seed: str):
        self.seed, self.k, self.pool = seed, 0, b""

    def number(self, below: int) -> int:
        if len(self.pool) < 4:
            self.pool = hashlib.sha256(f"{self.seed}/{self.k}".encode()).digest()
            self.k += 1
        n, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return n % below

    def text(self, chars: str, least: int, most: int) -> str:
        return "".join(chars[self.number(len(chars))] for _ in range(least + self.number(most - least + 1)))

    def pick(self, choices):
        return choices[self.number(len(choices))]


# Alphabets of the drawn values.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIXED = DIGITS + LOWER + UPPER


def _mixed(draw: _Draw, least: int, most: int, more: str = "") -> str:
    """Letters of both cases and digits, at least two of each."""
    value = draw.text(MIXED + more, least - 6, most - 6) + "".join(draw.text(c, 2, 2) for c in (DIGITS, LOWER, UPPER))
    at = draw.number(len(value))
    return value[at:] + value[:at]


#: Forms of a secret that no base pattern finds: (text before, value, text after).
REWRITES = {
    "upper hex": lambda d: (d.pick(["", "key ", "id="]), d.text(DIGITS + "ABCDEF", 32, 48), ""),
    "base64": lambda d: (d.pick(["", "key: ", '"', "use "]), _mixed(d, 32, 64, "+/"), d.pick(["", "==", '"'])),
    "mixed": lambda d: (d.pick(["", "pwd=", "auth ", "key = '"]), _mixed(d, 20, 44), ""),
    "prefixed": lambda d: (d.pick(["", "export K=", "with "]), d.pick(["ghp_", "xoxb-", "pk_test_"]) + _mixed(d, 24, 40), ""),
    "bearer": lambda d: ("Authorization: Bearer ", _mixed(d, 24, 60, "_-"), ""),
    "dotted": lambda d: ("", ".".join(_mixed(d, n, n + 20, "_-") for n in (16, 24, 24)), ""),
}
#: Values that look like secrets and are none.
LOOKALIKES = {
    "uuid": lambda d: "-".join(d.text(DIGITS + "abcdef", n, n) for n in (8, 4, 4, 4, 12)),
    "digits": lambda d: d.text(DIGITS, 8, 24),
    "path": lambda d: "/" + "/".join(d.text(LOWER, 3, 9) for _ in range(4)) + d.text(DIGITS, 1, 2) + "." + d.text(LOWER, 2, 3),
    "version": lambda d: ".".join(d.text(DIGITS, 1, 2) for _ in range(3)) + "-" + d.text(LOWER, 4, 8),
    "time": lambda d: f"20{d.text(DIGITS, 2, 2)}-0{d.text(DIGITS, 1, 1)}-1{d.text(DIGITS, 1, 1)}T0{d.text(DIGITS, 1, 1)}",
    "code": lambda d: d.text(UPPER, 2, 5) + "-" + d.text(DIGITS, 3, 8),
    "name": lambda d: "".join(d.text(UPPER, 1, 1) + d.text(LOWER, 3, 8) for _ in range(4)),
    "constant": lambda d: "_".join(d.text(UPPER, 4, 9) for _ in range(4)),
    "word": lambda d: d.text(LOWER, 18, 30),
    "identifier": lambda d: d.text(LOWER, 4, 8) + d.pick(["", "_"]) + d.text(LOWER, 4, 9) + d.text(DIGITS, 1, 3),
}


def rewritten(text: str, base: list[tuple[int, int, int, int]], variant: int = 0, rewrites=None, lookalikes=None):
    """``text`` with each base span in another form, or a look-alike of one in
    its place, and the (start, end) of the secret values."""
    rewrites, lookalikes = rewrites or REWRITES, lookalikes or LOOKALIKES
    out, values, size, at = [], [], 0, 0
    draw = _Draw(f"{variant} {text}")
    for _, a, b, _ in sorted(base, key=lambda s: s[1]):
        if a < at:
            continue
        before, value, after = "", "", ""
        if draw.number(2):
            before, value, after = rewrites[draw.pick(sorted(rewrites))](draw)
        else:
            before = draw.pick(["", "key ", "id=", "use "]) + lookalikes[draw.pick(sorted(lookalikes))](draw)
        start = size + a - at + len(before)
        if value:
            values.append((start, start + len(value)))
        part = text[at:a] + before + value + after
        out.append(part)
        size += len(part)
        at = b
    return "".join(out) + text[at:], values


def tokens(raw):
    """(starts, ends) of the tokens of a byte array."""
    import numpy as np

    inside = np.zeros(257, bool)
    for c in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_.-":
        inside[c] = True
    inside[128:256] = True
    edge = np.diff(np.concatenate(([0], inside[raw].view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def token_features(raw, starts, ends, doc_of, file_level):
    """One row per token: length, shape, digits and letter-digit changes,
    character before, word before, shapes before and after, file level,
    changes of case with the length, and marks with the kinds of letters."""
    import numpy as np

    n = len(starts)
    cls = np.full(256, 6, np.uint8)  # other
    for k, chars in enumerate([b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                               b"+/_.-"]):
        cls[list(chars)] = k
    cls[128:] = 5
    kind = cls[raw]
    length = ends - starts

    def per_token(flags):
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))
        return total[ends] - total[starts]

    digits = per_token(kind == 3)
    upper, low_other, low_hex = per_token(kind == 2), per_token(kind == 1), per_token(kind == 0)
    marks, wide = per_token(kind == 4), per_token(kind == 5)
    letter = (kind <= 2)
    change = np.concatenate(([False], (letter[1:] & (kind[:-1] == 3)) | (letter[:-1] & (kind[1:] == 3))))
    changes = per_token(change)
    lower_case = kind <= 1
    case = np.concatenate(([False], (lower_case[1:] & (kind[:-1] == 2)) | (lower_case[:-1] & (kind[1:] == 2))))
    cases = per_token(case)
    shape = ((low_hex + low_other > 0) * 1 + (upper > 0) * 2 + (digits > 0) * 4 + (marks > 0) * 8 + (wide > 0) * 16
             + ((low_other + upper + marks + wide == 0) & (length >= 8)) * 32)
    before = np.zeros(256, np.int64)
    for k, chars in enumerate([b" \t", b"\n\r", b"=", b":", b"\"'`", b",;()[]{}<>"]):
        before[list(chars)] = k + 1
    lead = np.where(starts > 0, before[raw[np.maximum(starts - 1, 0)]], 7)
    lower = np.where(kind == 2, raw + 32, raw).astype(np.uint64)
    place = np.arange(len(raw), dtype=np.int64)
    if n:
        place -= np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    weight = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)], np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((lower + np.uint64(1)) * weight[place & 63], dtype=np.uint64)))
    word = ((total[ends] - total[starts]) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(52)).astype(np.int64)
    # Neighbours are of the same text only.
    same = np.concatenate(([False], doc_of[1:] == doc_of[:-1])) if n else np.zeros(0, bool)
    prev_word, prev_shape, next_shape = np.zeros(n, np.int64), np.full(n, 63), np.full(n, 63)
    prev_word[1:], prev_shape[1:], next_shape[:-1] = word[:-1], shape[:-1], shape[1:]
    prev_word[~same], prev_shape[~same] = 0, 63
    if n:
        next_shape[:-1][~same[1:]] = 63
    columns = [np.minimum(length, 31), shape, np.minimum(digits, 7) * 8 + np.minimum(changes, 7), lead, prev_word,
               prev_shape, next_shape, file_level[doc_of] if n else np.zeros(0, np.int64),
               np.minimum(cases, 7) * 8 + np.minimum(length // 6, 7),
               np.minimum(marks, 7) * 4 + (upper > 0) * 2 + (low_other > 0)]
    return np.stack(columns, axis=1).astype(np.int32)


class Stretch:
    """Texts side by side, parted by a zero byte, and their tokens."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        self.raw = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
        self.begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.starts, self.ends = tokens(self.raw)
        self.doc = np.searchsorted(self.begin, self.starts, "right") - 1
        # File features: assignments, braces, quotes, line breaks per size, in four steps each of two.
        level = []
        for t in texts:
            n = len(t) + 1
            level.append(min(3, 400 * (t.count(b"=") + t.count(b":")) // n) * 4
                         + min(3, 400 * (t.count(b"{") + t.count(b";") + t.count(b'"')) // n))
        self.x = token_features(self.raw, self.starts, self.ends, self.doc, np.array(level + [0], np.int64))


class Tagger:
    """Weights of the field: one row of three scores per feature value, and transitions."""

    def __init__(self):
        import numpy as np

        self.offset = np.concatenate(([0], np.cumsum(SIZES)[:-1]))
        self.w = np.zeros((sum(SIZES), 3))
        self.t = np.zeros((3, 3))
        self.trained = False

    def emissions(self, x):
        e = self.w[x[:, 0] + self.offset[0]]
        for k in range(1, len(SIZES)):
            e = e + self.w[x[:, k] + self.offset[k]]
        return e

    def fit(self, x, y, mask) -> "Tagger":
        """``x`` (windows, tokens, features), tags ``y``, ``mask`` of real tokens;
        Adagrad on the conditional log-likelihood, by forward and backward sums."""
        import numpy as np

        if not len(x) or not (y > 0).any():
            return self
        index = x + self.offset
        n, m = y.shape
        gw, gt = np.full_like(self.w, 1e-8), np.full_like(self.t, 1e-8)
        onehot = np.eye(3)[y] * mask[:, :, None]
        previous = np.concatenate((np.zeros((n, 1), np.int64), np.where(mask, y, 0)[:, :-1]), axis=1)
        for _ in range(EPOCHS):
            e = np.where(mask[:, :, None], self.w[index].sum(axis=2), [0.0, -50.0, -50.0])
            forward, back = np.zeros((n, m, 3)), np.zeros((n, m, 3))
            forward[:, 0] = e[:, 0] + self.t[0]
            for k in range(1, m):
                forward[:, k] = e[:, k] + np.logaddexp.reduce(forward[:, k - 1, :, None] + self.t, axis=1)
            for k in range(m - 2, -1, -1):
                back[:, k] = np.logaddexp.reduce(self.t + (e[:, k + 1] + back[:, k + 1])[:, None, :], axis=2)
            z = np.logaddexp.reduce(forward[:, -1], axis=1)
            p = np.exp(forward + back - z[:, None, None]) * mask[:, :, None]
            dw = np.zeros_like(self.w)
            diff = (p - onehot).reshape(-1, 3)
            for k in range(len(SIZES)):
                for tag in range(3):
                    dw[:, tag] += np.bincount(index[:, :, k].reshape(-1), diff[:, tag], len(dw))
            dt = np.zeros((3, 3))
            dt[0] += (p[:, 0] - onehot[:, 0]).sum(axis=0)
            for k in range(1, m):
                pair = np.exp(forward[:, k - 1, :, None] + self.t + (e[:, k] + back[:, k])[:, None, :]
                              - z[:, None, None]) * mask[:, k, None, None]
                dt += pair.sum(axis=0)
                np.add.at(dt, (previous[mask[:, k], k], y[mask[:, k], k]), -1.0)
            dw, dt = dw / n + DECAY * self.w, dt / n + DECAY * self.t
            gw += dw ** 2
            gt += dt ** 2
            self.w -= RATE * dw / np.sqrt(gw)
            self.t -= RATE * dt / np.sqrt(gt)
        # Calibration: as much less weight for O as leaves all but FALSE_SHARE of the hard outside tokens outside.
        hard = mask & (y == 0) & ((x[:, :, 0] >= HARD_LENGTH) | (x[:, :, 2] >= 16))
        if hard.any():
            outside = np.clip(p[:, :, 0][hard], 1e-12, 1 - 1e-12)
            lead = float(np.quantile(np.log(outside / (1 - outside)), FALSE_SHARE))
            self.w[:SIZES[0], 0] -= max(0.0, lead)
        self.trained = True
        return self

    def viterbi(self, e) -> list[int]:
        """Best tags of one stretch; outside stands before and after it."""
        t = self.t.tolist()
        score, back = [t[0][j] + e[0][j] for j in range(3)], []
        for row in e[1:]:
            steps = [max(range(3), key=lambda i: score[i] + t[i][j]) for j in range(3)]
            score = [score[steps[j]] + t[steps[j]][j] + row[j] for j in range(3)]
            back.append(steps)
        tag = max(range(3), key=lambda j: score[j] + t[j][0])
        tags = [tag]
        for steps in reversed(back):
            tag = steps[tag]
            tags.append(tag)
        return tags[::-1]

    def decode(self, stretch: Stretch) -> list[tuple[int, int, int]]:
        """(text number, first byte, end byte) of the tagged spans."""
        import numpy as np

        e = self.emissions(stretch.x)
        sure = e[:, 0] - e[:, 1:].max(axis=1) > 2 * (self.t.max() - self.t.min())
        open_ = np.flatnonzero(~sure)
        out = []
        # Stretches of open tokens that follow each other in one text.
        cut = np.flatnonzero((np.diff(open_) != 1) | (np.diff(stretch.doc[open_]) != 0)) + 1
        for run in np.split(open_, cut) if len(open_) else []:
            span = None
            for k, tag in zip(run.tolist(), self.viterbi(e[run].tolist())):
                if tag and span and tag == 2:
                    span[2] = int(stretch.ends[k])
                elif tag:
                    span = [int(stretch.doc[k]), int(stretch.starts[k]), int(stretch.ends[k])]
                    out.append(span)
                else:
                    span = None
        return [(d, a - int(stretch.begin[d]), b - int(stretch.begin[d])) for d, a, b in out]


def _stretches(texts: list[bytes]):
    """Numbers of texts that share a stretch."""
    k = 0
    while k < len(texts):
        stop, size = k, 0
        while stop < len(texts) and (stop == k or size + len(texts[stop]) <= UNIT):
            size += len(texts[stop])
            stop += 1
        yield k, stop
        k = stop


def _points(text: str, raw: bytes):
    """Byte offset -> code point offset."""
    if len(text) == len(raw):
        return lambda b: b
    import numpy as np

    ahead = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return lambda b: int(ahead[b])


def find_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, in code points."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    if tagger.trained:
        for a, b in _stretches(raws):
            for d, start, end in tagger.decode(Stretch(raws[a:b])):
                point = _points(texts[a + d], raws[a + d])
                s, f = point(start), point(end)
                if not any(x < f and s < y for _, x, y in base[a + d]):
                    every[a + d].append((3, s, f))
    order = lambda s: (s[1], s[0], s[2])
    return [(sorted(b, key=order), sorted(e, key=order)) for b, e in zip(base, every)]


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _tags(text: str, s: Stretch, values: list[tuple[int, int]]):
    """Tags of a text's tokens for the given values (code points)."""
    import numpy as np

    tag = np.zeros(len(s.starts), np.int64)
    for a, e in values:
        a, e = (len(text[:p].encode("utf-8", "surrogatepass")) for p in (a, e))
        inside = np.flatnonzero((s.starts < e) & (s.ends > a))
        tag[inside] = 2
        tag[inside[:1]] = 1
    return tag


def _sampler(batches):
    """Windows around tokens of base values and of rewritten ones (positive 1 and
    2), around what replaced the others (3), and at tokens chosen by hash (0)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows, tags, found = [], [], []

        def show(s, tag, k, positive):
            a, e = max(0, k - REACH), min(len(tag), k + REACH + 1)
            rows.append(s.x[a:e].reshape(-1).tolist())
            tags.append(tag[a:e].tolist())
            found.append(positive)

        for text in batch.column(0):
            text = text.as_py()
            raw = text.encode("utf-8", "surrogatepass")
            s = Stretch([raw])
            if not len(s.starts):
                continue
            base = _base(text)
            tag = _tags(text, s, [(a, e) for _, _, e, a in base])
            for k in np.flatnonzero(tag == 1).tolist():
                show(s, tag, k, 1)
            chosen = int(hashlib.md5(raw).hexdigest()[:8], 16)
            show(s, tag, chosen % len(tag), 0)
            # Ordinary tokens with digits are rare, so one of them is shown too.
            hard = np.flatnonzero((tag == 0) & (s.x[:, 2] > 0))
            if len(hard):
                show(s, tag, int(hard[chosen % len(hard)]), 0)
            for variant in range(VARIANTS if base else 0):
                other, values = rewritten(text, base, variant)
                if any(a < f and b < e for a, e in values for _, b, f in base_spans(other)):
                    continue
                s = Stretch([other.encode("utf-8", "surrogatepass")])
                tag = _tags(other, s, values)
                for k in np.flatnonzero(tag == 1).tolist():
                    show(s, tag, k, 2)
                # What is neither a value nor as it was in the text: look-alikes.
                for k in np.flatnonzero((tag == 0) & ((s.x[:, 2] >= 16) | (s.x[:, 0] >= HARD_LENGTH)))[:8].tolist():
                    show(s, tag, k, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int32())), pa.array(found, pa.int32())],
            names=["x", "y", "positive"])


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_windows: int = SAMPLE_WINDOWS) -> Tagger:
    import numpy as np

    d = only(docs, text_col).select(F.col(text_col).alias("text")).where("text is not null")
    n = d.count()
    tagger = Tagger()
    if not n:
        return tagger
    sample = d.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, sample_docs / n))))
    windows = sample.mapInArrow(_sampler, "x array<int>, y array<int>, positive int").groupBy("x", "y", "positive").agg(
        F.count("*").alias("n"))
    # At most ``sample_windows`` of each kind leave a task, and reach the driver.
    order = Window.partitionBy("positive").orderBy(F.xxhash64("x", "y"), "x", "y")
    rows = windows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_windows).collect()
    rows.sort(key=lambda r: (r["positive"], r["rank"]))
    width = 2 * REACH + 1
    x = np.zeros((len(rows), width, len(SIZES)), np.int64)
    y, mask = np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), bool)
    for i, r in enumerate(rows):
        k = len(r["y"])
        x[i, :k], y[i, :k], mask[i, :k] = np.reshape(r["x"], (k, len(SIZES))), r["y"], True
    # Every window once more without its cues, so that shape alone counts as well.
    bare = x.copy()
    bare[:, :, 3], bare[:, :, 4] = 1, 0
    return tagger.fit(*(np.concatenate(pair) for pair in ((x, bare), (y, y), (mask, mask))))


def _finder(tagger: Tagger):
    def find(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            rows = []
            for doc, (base, every) in zip(batch.column(0).to_pylist(), find_spans(tagger, texts)):
                n = [sum(k == kind for k, _, _ in base) for kind in range(3)]
                rows.append((doc, *n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(every),
                             len(every) - len(base)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = ["doc_id", *(f"n_{k}" for k in KINDS[:3]), "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, kinds)], names=names)

    return find


def secrets(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, base counts, ``base_sha256``, ``spans``, ``n_added``."""
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_finder(tagger), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                         "spans string, n_added long")


def _masker(tagger: Tagger, text_at: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, (_, every) in enumerate(find_spans(tagger, [t or "" for t in texts])):
                if not every:
                    continue
                out, at = [], 0
                for _, a, b in every:
                    if a >= at:
                        out += [texts[i][at:a], MASK]
                    at = max(at, b)
                texts[i] = "".join(out) + texts[i][at:]
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, pa.string()))

    return run


def masked(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by ``[SECRET]``, all columns kept."""
    plain = positional(docs)
    return plain.mapInArrow(_masker(tagger, docs.columns.index(text_col)), plain.schema).toDF(*docs.columns)


def op8_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets(docs, train(docs))
