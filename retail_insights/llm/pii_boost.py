"""Personal data: base patterns, and boosted trees over wider candidates.

Base spans (email, ip, card, phone) follow fixed patterns and always stay.
High-recall generators propose further, overlapping spans per kind.  A boosted
forest of small trees scores each candidate by its format (lengths, digit
groups, separators) and its context (neighbouring characters, the words
before).  It learns other spellings from a bounded sample of documents: each
base span is rewritten (plus sign dropped, at sign as (at), other separators),
and the candidate on the rewritten span is right.  Wrong are candidates that a
check refutes (see ``refuted``), that lie on data of another kind, or on a look-alike
(date, ISBN, number list) put in a base span's place.  Other candidates are
unknown and teach nothing.  The threshold is calibrated on examples that
training did not see and no check refutes: the lowest that keeps the wanted
precision.  Refuted candidates are never accepted; of overlapping accepted ones the best is kept,
of equally good ones the longest.

Prediction is one narrow pass.  Training sees at most ``SAMPLE_DOCS`` documents
(in expectation, chosen by hash) and ``SAMPLE_CANDIDATES`` candidates.

Defined results: null and empty texts have no spans; repeated rows are judged
one by one; without candidates to learn from only base spans are found; other
columns (clashing names included) are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import only, table

# Kinds in their order, and the base patterns.
KINDS = ["email", "ip", "card", "phone"]
EMAIL_DOMAIN = r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Generators: kind and pattern of wider candidates.
_LOCAL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+"
GENERATORS = [
    ("email", _LOCAL + r"(?:(?:\.|\(dot\)|\[dot\]| dot )[A-Za-z0-9-]+)+"),
    ("email", _LOCAL + r"(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+"),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![\w])"),
    ("card", r"(?<!\w)[0-9]{3,6}(?:[ ./-]?[0-9]{2,7}){2,5}(?!\w)"),
    ("phone", r"(?<!\w)(?! )(?:\+|00)?[ (]{0,3}[0-9]{1,4}[)]?(?:[ ./()-]{0,2}[0-9]{2,4}){2,4}(?!\w)"),
]
#: Other spellings of each kind, as functions of the base span and its digits.
REWRITES = [
    [lambda t, d: t.replace("@", "(at)"), lambda t, d: t.replace("@", " at "), lambda t, d: t.replace("@", " [at] "),
     lambda t, d: t.split("@")[0] + "(at)" + t.split("@")[1].replace(".", "(dot)"),
     lambda t, d: t.split("@")[0] + " at " + t.split("@")[1].replace(".", " dot ")],
    [lambda t, d: t.replace(".", ","), lambda t, d: t.replace(".", " . "), lambda t, d: t.replace(".", " ."),
     lambda t, d: t.replace(".", ". ")],
    [lambda t, d: ".".join(d[k:k + 4] for k in range(0, len(d), 4)), lambda t, d: "/".join(d[k:k + 4] for k in range(0, len(d), 4))],
    [lambda t, d: t.lstrip("+"), lambda t, d: "00" + t.lstrip("+"), lambda t, d: f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}",
     lambda t, d: f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", lambda t, d: f"{d[-10:-7]}.{d[-7:-4]}.{d[-4:]}",
     lambda t, d: f"{d[:-10]} {d[-10:-7]} {d[-7:-4]} {d[-4:]}".strip()],
]
#: What is no personal data, as functions of digits.
LOOKALIKES = [
    lambda d: f"20{d[:2]}-0{int(d[2]) % 9 + 1}-1{d[3]} 1{d[4]}.{int(d[5]) % 6}{d[6]}", lambda d: f"1{d[0]}.0{int(d[1]) % 9 + 1}.19{d[2:4]}",
    lambda d: f"978-{d[0]}-{d[1:3]}-{d[3:7]}00-{d[0]}", lambda d: f"19{d[:2]}-19{d[2:4]} 20{d[4:6]}-20{d[6:8]}",
    lambda d: f"{int(d[0]) + 1}{d[1]}, {int(d[2]) + 1}{d[3]}, {int(d[4]) + 1}{d[5]}, {int(d[6]) + 1}{d[7]}",
    lambda d: f"{int(d[0]) + 1}{d[1]} {d[2:5]} {d[5:8]} 000", lambda d: (d * 2)[:10],
]
#: Words that announce each kind.
CUES = [frozenset("email mail e-mail contact write".split()), frozenset("ip address host server from".split()),
        frozenset("card visa mastercard credit payment".split()),
        frozenset("phone tel telephone call mobile fax".split())]
SAMPLE_DOCS, SAMPLE_CANDIDATES = 20_000, 20_000
PRECISION = 0.99
BINS = 32


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each at sign: the local
    part is the run of its characters before the sign."""
    out, free, domain = [], 0, re.compile(EMAIL_DOMAIN)
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        m = domain.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in code points."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not re.search("[0-9]", text):
        return out
    # A match can only start where a run of digits does; saying so keeps long runs linear.
    for m in re.finditer("(?<![0-9])" + IP, text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(CARD, text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in re.finditer(PHONE, text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def _char_class(c: str) -> int:
    if not c:
        return 0
    return 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in ".,;:!?" else 5


def features(text: str, kind: int, start: int, end: int) -> list[int]:
    """Small numbers that describe a candidate and its surroundings."""
    span = text[start:end]
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    letters = re.findall("[A-Za-z]+", span)
    before = re.findall(r"[\w-]+", text[max(0, start - 40):start].lower())[-3:]
    around = text[max(0, start - 20):start] + text[end:end + 20]
    out = [kind, len(span), sum(groups), len(groups), *(groups + [0] * 4)[:4], groups[-1] if groups else 0,
           len(letters), max(map(len, letters), default=0), len(letters[-1]) if letters else 0,
           span.count("."), span.count("-"), span.count(" "), span.count("(") + span.count(")"),
           _char_class(text[start - 1:start]), _char_class(text[end:end + 1]),
           sum(c.isdigit() for c in around), any(w in CUES[kind] for w in before)]
    return [min(int(x), BINS - 1) for x in out]


_EVERY = [(KINDS.index(kind), re.compile(f"(?=({pattern}))")) for kind, pattern in GENERATORS]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end): matches from every start, overlapping ones too."""
    has_digit = re.search("[0-9]", text)
    has_at = any(at in text for at in ("@", "(at)", "[at]", " at "))
    out = set()
    for kind, pattern in _EVERY:
        if has_digit if kind else has_at:
            out.update((kind, *m.span(1)) for m in pattern.finditer(text))
    return sorted(out)


def refuted(kind: int, span: str) -> bool:
    """Whether a check shows that a candidate is not of its kind: an at without
    marks before a sentence's end, a part above 255 or a list, wrong check
    digit, too few or too many digits."""
    if kind == 0:
        return " at " in span and ". " in span
    if kind == 1:
        return ", " in span or any(int(p) > 255 for p in re.findall("[0-9]+", span))
    digits = re.sub("[^0-9]", "", span)
    if kind == 2:
        return not (13 <= len(digits) <= 19 and luhn(digits))
    return not 9 <= len(digits.removeprefix("00")) <= 15


class Forest:
    """Gradient boosting with logistic loss: trees of depth three over binned features."""

    def __init__(self, rounds: int = 40, rate: float = 0.3, depth: int = 3):
        self.rounds, self.rate, self.depth = rounds, rate, depth
        self.trees: list[tuple[list[int], list[int], list[float]]] = []
        self.start, self.threshold = 0.0, 2.0

    def _tree(self, x, grad, hess):
        """One tree in heap order: split feature and bin per inner node, value per leaf."""
        import numpy as np

        inner = (1 << self.depth) - 1
        feature, cut = [0] * inner, [BINS] * inner
        node = np.zeros(len(x), np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = 1e-9
            g, h = grad[rows].sum(), hess[rows].sum()
            for f in range(x.shape[1]) if len(rows) else []:
                gl = np.cumsum(np.bincount(x[rows, f], grad[rows], BINS))[:-1]
                hl = np.cumsum(np.bincount(x[rows, f], hess[rows], BINS))[:-1]
                gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
                b = int(gain.argmax())
                if gain[b] > best:
                    best, feature[k], cut[k] = gain[b], f, b
            node[rows] = 2 * k + 1 + (x[rows, feature[k]] > cut[k])
        leaf = node - inner
        n = inner + 1
        value = -np.bincount(leaf, grad, n) / (np.bincount(leaf, hess, n) + 1) * self.rate
        return feature, cut, value.tolist()

    def raw(self, x):
        import numpy as np

        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            feature, cut, node = np.array(feature), np.array(cut), np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += np.array(value)[node - len(feature)]
        return out

    def probability(self, x):
        import numpy as np

        return 1 / (1 + np.exp(-self.raw(x)))

    def fit(self, x, y, fresh) -> "Forest":
        """Learns from the rows that are not ``fresh``; the threshold from those that are."""
        import numpy as np

        xt, yt = x[~fresh], y[~fresh]
        if len(yt) < 20 or yt.min() == yt.max():
            return self
        self.start = float(np.log(yt.mean() / (1 - yt.mean())))
        score = np.full(len(yt), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            self.trees.append(self._tree(xt, p - yt, p * (1 - p)))
            feature_only = Forest(depth=self.depth)
            feature_only.trees = self.trees[-1:]
            score += feature_only.raw(xt)
        p, truth = self.probability(x[fresh]), y[fresh]
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        # A threshold takes all candidates of equal score together.
        ends = np.append(np.diff(p[order]) != 0, True) if len(order) else np.zeros(0, bool)
        good = np.flatnonzero((right >= PRECISION) & ends & (p[order] >= 0.5))
        if len(good):
            self.threshold = float(p[order][good[-1]])
        return self


def _put(text: str, start: int, end: int, new: str) -> tuple[str, int, int]:
    """The surroundings of a span with other words in its place, and their span there."""
    before = text[max(0, start - 60):start]
    return before + new + text[end:end + 60], len(before), len(before) + len(new)


def examples(text: str) -> list[tuple[list[int], int]]:
    """(features, 1 right, 0 wrong or -1 refuted by a check) of the candidates in
    a text whose truth is known."""
    base, out = base_spans(text), []
    meets = lambda a, b, s, e: s < b and a < e
    for kind, a, b in candidates(text):
        on = {k for k, s, e in base if meets(a, b, s, e)}
        if kind not in on and (on or refuted(kind, text[a:b])):
            out.append((features(text, kind, a, b), -int(refuted(kind, text[a:b]))))
    for kind, start, end in base:
        span = text[start:end]
        digits = re.sub("[^0-9]", "", span)
        for rewrite in REWRITES[kind]:
            other, s, e = _put(text, start, end, rewrite(span, digits))
            for k, a, b in candidates(other):
                if k == kind and (a, b) == (s, e):
                    out.append((features(other, k, a, b), 1))
                elif k != kind and meets(a, b, s, e):
                    out.append((features(other, k, a, b), -int(refuted(k, other[a:b]))))
        number = f"{int(hashlib.sha256(span.encode()).hexdigest()[:12], 16) % 10 ** 8:08d}"
        for lookalike in LOOKALIKES:
            other, s, e = _put(text, start, end, lookalike(number))
            out += [(features(other, k, a, b), -int(refuted(k, other[a:b]))) for k, a, b in candidates(other)
                    if meets(a, b, s, e)]
    return out


def _sampler(batches):
    import pyarrow as pa

    for batch in batches:
        known = [x for text in batch.column(0) for x in examples(text.as_py())]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in known], pa.list_(pa.int32())),
                                          pa.array([y for _, y in known], pa.int32())], names=["x", "y"])


def _fit(x, y) -> Forest:
    """What a check refutes is never accepted, so it does not count in calibration."""
    import numpy as np

    return Forest().fit(x, np.maximum(y, 0), (np.arange(len(x)) % 5 == 0) & (y >= 0))


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_candidates: int = SAMPLE_CANDIDATES) -> Forest:
    import numpy as np

    d = only(docs, text_col).select(F.col(text_col).alias("text"))
    n = d.count()
    if not n:
        return Forest()
    sample = d.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, sample_docs / n))))
    sample = sample.where(F.col("text").rlike(r"[0-9@]|\(at\)|\[at\]| at "))
    rows = (sample.mapInArrow(_sampler, "x array<int>, y int").groupBy("x", "y").agg(F.count("*").alias("n"))
            .orderBy(F.xxhash64("x", "y"), "x", "y").limit(sample_candidates).collect())
    if not rows:
        return Forest()
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["y"]) for r in rows])
    return _fit(x, y)


def all_spans(text: str, base: list, found: list, p, threshold: float) -> list[tuple[int, int, int]]:
    """Base spans and the accepted candidates that overlap none of them, best
    first, of equally good ones the longest."""
    taken = [(a, b) for _, a, b in base]
    out = list(base)
    for score, (kind, a, b) in sorted(zip(p, found), key=lambda s: (-round(s[0], 2), s[1][1] - s[1][2], s[1])):
        if score >= threshold and not any(s < b and a < e for s, e in taken):
            taken.append((a, b))
            out.append((kind, a, b))
    return sorted(out)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _finder(forest: Forest):
    def find(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                base = base_spans(text)
                found = [c for c in candidates(text) if not refuted(c[0], text[c[1]:c[2]])] if forest.trees else []
                found = [c for c in found if not any(s < c[2] and c[1] < e for _, s, e in base)]
                p = forest.probability(np.array([features(text, *c) for c in found])).tolist() if found else []
                spans = all_spans(text, base, found, p, forest.threshold)
                n = [sum(k == kind for k, _, _ in base) for kind in range(4)]
                rows.append((doc, *n, hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans),
                             len(spans) - len(base)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 8, kinds)], names=names)

    return find


def personal_data(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, base counts, ``base_sha256``, ``spans``, ``n_added``."""
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return d.mapInArrow(_finder(forest), f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def op10_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return personal_data(docs, train(docs))
