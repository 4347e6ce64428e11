"""Language identification by prediction by partial matching.

Each language has a byte context tree of contexts up to ``ORDER`` bytes.  A
byte is coded in the longest context known for its language: with ``c`` of
``n`` occurrences among ``d`` different bytes it costs ``-log2(c / (n + d))``
bits; a byte not seen there costs the escape, ``-log2(d / (n + d))``, and is
coded in the next shorter context; below the empty context all 256 bytes are
equally likely.  Statistics are frozen after training.  The language with the
shortest code for the whole text wins; the score is its share of probability
under equal priors.

Training counts come from a sample of labelled rows chosen by hash, about
``TRAIN_DOCS`` documents a language (the documented bound of the model);
counting runs on Spark.  Prediction is one narrow pass: nothing is shuffled.

Code lengths choose among the known languages and reject nothing: any text with
a letter gets one of them, noise and unknown scripts included.

Defined results: null text, or text without a letter, is ``und`` with score 0;
so is everything if no labelled row exists; rows with a null id are not held
out and not learned from; ties between languages go to the first by name;
repeated rows are predicted one by one; other columns (clashing names
included) are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import only, place, positional, table

ORDER = 3
TRAIN_DOCS = 1500
#: Contexts seen less often than this, over all languages, are left out of the trees.
MIN_CONTEXT = 4
UNDETERMINED = "und"
#: A text in none of the learned languages: even the best codes it in more bits
#: a byte than these (plain bytes take 8).  On sf0.1 the labelled documents, junk
#: included, take 1.2 to 6.9 bits; random letters, other scripts and markup 12.7
#: to 21.
MAX_BITS = 10.0
#: Bytes that a task scores at once (a longer document in stretches of this size).
UNIT = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _gram_counter(order: int):
    """(lang, text) -> (lang, gram, n): counts of each byte after its ``order``
    bytes of context, packed base 257 (0 stands before the text)."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            langs = batch.column(0).to_pylist()
            by_lang = {}
            for lang, text in zip(langs, batch.column(1)):
                raw = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                code = np.concatenate((np.zeros(order, np.int64), raw.astype(np.int64) + 1))
                gram = np.zeros(len(raw), np.int64)
                for k in range(order + 1):
                    gram = gram * 257 + code[k:k + len(raw)]
                by_lang.setdefault(lang, []).append(gram)
            for lang, grams in by_lang.items():
                g, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])

    return count


def train(docs: DataFrame, order: int = ORDER, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict:
    """Frozen statistics: the languages and the counts of their contexts."""
    d = only(docs, id_col, text_col, lang_col).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = d.where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("text").isNotNull()
                       & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"order": order, "langs": [], "lang": [], "gram": [], "n": []}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, train_docs / n))).otherwise(share)
    sample = labelled.where(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < share * 1_000_000)
    counts = (sample.select("lang", "text").mapInArrow(_gram_counter(order), "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(sizes)
    number = {lang: i for i, lang in enumerate(langs)}
    return {"order": order, "langs": langs, "lang": counts["lang"].map(number).to_numpy("int16"),
            "gram": counts["gram"].to_numpy("int64"), "n": counts["n"].to_numpy("int64")}


class ContextTrees:
    """The trees of all languages over one set of contexts, as dense tables:
    ``child`` finds the longest known context, ``bits`` the code lengths."""

    def __init__(self, model: dict, min_context: int = MIN_CONTEXT):
        import numpy as np

        self.langs, order = model["langs"], model["order"]
        self.order, L = order, len(self.langs)
        lang, gram, n = (np.asarray(model[k]) for k in ("lang", "gram", "n"))
        digits = np.stack([gram // 257 ** (order - k) % 257 for k in range(order + 1)]) if len(gram) else np.zeros(
            (order + 1, 0), np.int64)
        # Symbols: 0 before the text, 1.. the bytes met in training, the last for all others.
        known = np.unique(digits[order])
        self.S = S = len(known) + 2
        self.symbol = np.full(257, S - 1, np.int64)
        self.symbol[0] = 0
        self.symbol[known] = np.arange(1, len(known) + 1)
        sym = self.symbol[digits]
        node = np.zeros(len(gram), np.int64)
        alive = np.ones(len(gram), bool)
        levels = [(np.array([0]), np.array([0]))]
        total, edges = 1, []
        for k in range(order + 1):
            if k:
                # Children of the last level's contexts by the byte before them.
                key = np.where(alive, node * S + sym[order - k], -1)
                found, inverse = np.unique(key, return_inverse=True)
                weight = np.bincount(inverse, n, len(found))
                good = (weight >= min_context) & (found >= 0)
                ids = np.where(good, total + np.cumsum(good) - 1, -1)
                edges.append((found[good], ids[good]))
                levels.append((found[good] // S, ids[good]))
                total += int(good.sum())
                child = ids[inverse]
                alive = child >= 0
                node = np.where(alive, child, node)
            here = np.flatnonzero(alive)
            cell = (node[here] * S + sym[order][here]) * L + lang[here]
            levels[k] += (cell, n[here])
        self.N = total
        self.child = np.empty((2 * total, S), np.int32)
        self.child[:] = (np.arange(2 * total) % total + total)[:, None]  # no child: stay, and look no further
        for found, ids in edges:
            self.child.reshape(-1)[found] = ids
        self.bits = np.zeros((total, S, L), np.float32)
        for parents, ids, cell, weight in levels:
            start = int(ids[0]) if len(ids) else 0
            base = (np.full((1, S, L), 8.0, np.float32) if len(levels[0][1]) and start == 0
                    else self.bits[parents])
            c = np.zeros((len(ids), S, L))
            np.add.at(c.reshape(-1), cell - start * S * L, weight)
            total_n, distinct = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total_n > 0, -np.log2(distinct / (total_n + distinct)), 0.0)
                seen = -np.log2(c / (total_n + distinct))
            self.bits[ids] = np.where(c > 0, seen, escape + base)
        self.bits[:, 0, :] = 0.0

    def code_lengths(self, texts: list[bytes]):
        """Bits of each whole text in each language."""
        import numpy as np

        out = np.zeros((len(texts), len(self.langs)))
        k, at = 0, 0
        while k < len(texts):
            # Stretches of several texts, or of one long text with its context before it.
            parts, owners, size = [], [], 0
            while k < len(texts) and size < UNIT:
                raw = np.frombuffer(texts[k], np.uint8)
                take = raw[at:at + UNIT - size]
                if at:
                    lead = self.symbol[raw[at - self.order:at].astype(np.int64) + 1] if at >= self.order else \
                        np.concatenate((np.zeros(self.order - at, np.int64), self.symbol[raw[:at].astype(np.int64) + 1]))
                else:
                    lead = np.zeros(self.order, np.int64)
                parts.append((lead, self.symbol[take.astype(np.int64) + 1]))
                owners.append(k)
                size += len(take) + self.order
                at += len(take)
                if at >= len(raw):
                    k, at = k + 1, 0
                else:
                    break
            code = np.concatenate([x for p in parts for x in p])
            n = len(code)
            state = np.zeros(n, np.int64)
            flat = self.child.reshape(-1)
            for j in range(1, self.order + 1):
                before = np.concatenate((np.zeros(min(j, n), np.int64), code[:max(0, n - j)]))
                state = flat[state * self.S + before].astype(np.int64)
            bits = self.bits.reshape(-1, len(self.langs))[(state % self.N) * self.S + code]
            lengths = np.array([len(b) + self.order for _, b in parts])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            for j in range(self.order):
                bits[starts + j] = 0  # the context itself is not coded
            sums = np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
            np.add.at(out, owners, sums)
        return out

    def predict(self, texts: list[bytes]):
        """(language number, score, bits of the best) per text."""
        import numpy as np

        bits = self.code_lengths(texts)
        best = bits.argmin(axis=1)
        low = bits.min(axis=1)
        score = 1.0 / np.exp2(np.maximum(low[:, None] - bits, -1000.0)).sum(axis=1)
        return best, score, low


def _predictor(model: dict, text_at: int, max_bits: float | None = None):
    """Rows whose last column says whether the text has a letter -> their
    columns but text and last with the prediction, or, with ``max_bits``, the
    rows that their language codes in that many bits a byte or fewer."""

    def run(batches):
        import pyarrow as pa

        trees = ContextTrees(model) if len(model["langs"]) else None
        for batch in batches:
            texts, letters = batch.column(text_at), batch.column(batch.num_columns - 1).to_pylist()
            use = [k for k, x in enumerate(letters) if x and trees]
            lang, score, bits = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows, [None] * batch.num_rows
            for a in range(0, len(use), 1024):
                part = use[a:a + 1024]
                raw = [texts[k].as_py().encode("utf-8", "surrogatepass") for k in part]
                for k, r, b, s, n in zip(part, raw, *(x.tolist() for x in trees.predict(raw))):
                    lang[k], score[k], bits[k] = trees.langs[b], min(1.0, s), n / len(r)
            names = batch.schema.names
            if max_bits is not None:
                ok = pa.array([b is not None and b <= max_bits for b in bits], pa.bool_())
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=names[:-1]).filter(ok)
            else:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:text_at], pa.array(lang), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
                    names=[*names[:text_at], "lang_pred", "score", "bits_per_byte"])

    return run


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def predict_language(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, bits_per_byte)`` per input row."""
    d = only(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", _has_letter(F.col("text")).alias("ok"))
    return d.mapInArrow(_predictor(model, 2),
                        "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def with_language(docs: DataFrame, model: dict, text_col: str = "text", max_bits: float = MAX_BITS) -> DataFrame:
    """The rows whose text a learned language explains, all columns kept: texts
    without a letter go, and those that even the best language codes in more
    than ``max_bits`` bits a byte.  If no language was learned, none is kept."""
    plain, text = positional(docs), place(docs, text_col)
    judged = plain.select("*", _has_letter(F.col(text)).alias("letter"))
    return judged.mapInArrow(_predictor(model, docs.columns.index(text_col), max_bits), plain.schema).toDF(*docs.columns)


def op2_ppm_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, train(docs))
