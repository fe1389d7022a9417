"""Language ID: a linear-chain conditional random field over words.

Affix, n-gram and lexicon features (hashed) score each word for each language, learned
transitions tie neighbours, forward-backward over the whole text gives each word's posterior,
so code-switched text gets a label per word (blocks of CHAIN words are computed side by side,
with exact messages between them). A document's language is the one with the largest share of the
posterior of its words; that share is the score.

It is fitted on a bounded sample: at most PER_LANG documents of each language, of at most
SAMPLE_CHARS characters, the first by a hash of doc_id, of those whose crc32(doc_id) mod 5
isn't 0. Prediction covers every word of every text.

Defined results: null text, or text without a letter, is `und` with score 0; without any
labelled row all is `und`; a null doc_id isn't learned from and counts as not held out;
repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagos.llm import bytehash as bh
from pelagos.llm.names import free_name
from pelagos.session import long_rows, table

NAME = "op6_conditional_random_field"
PER_LANG, SAMPLE_CHARS, CHAIN, BITS, EPOCHS, SEED = 120, 20_000, 64, 16, 6, 6
NEAREST = 0.5  # score under which the pipeline's stage rejects a document
LETTER = re.compile(r"[^\W\d_]")
FAMILIES = ("bigram", "trigram", "4-gram", "prefix", "suffix", "lexicon")


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # families x 2**BITS x languages
    trans: np.ndarray  # from x to


def features(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashed feature ids: of each byte (three n-gram families) and of each word (three)."""
    b = np.where(bh._WHITE[b], 32, b).astype(np.uint32)
    p = np.concatenate([[32], b, [32, 32, 32]]).astype(np.uint32)
    n, shift, m = len(b), np.uint32(32 - BITS), np.uint32(2654435761)
    with np.errstate(over="ignore"):
        two = (p[:n] << 8) | p[1:n + 1]
        three = ((two << 8) | p[2:n + 2])
        four = ((three << 8) | p[3:n + 3])
        grams = [((x + np.uint32(i)) * m) >> shift for i, x in enumerate((two, three, four))]
        head = four[start] * m ^ p[np.minimum(start + 4, n + 3)] * np.uint32(40503)
        tail = four[np.maximum(end - 3, 0)] * m ^ (end - start == 1).astype(np.uint32)
        affix = [(x * m) >> shift for x in (head, tail)]
    lexicon = (bh.spans(bh.sums(b.astype(np.uint8)), start, end) >> np.uint64(64 - BITS)).astype(np.uint32)
    return grams, [*affix, lexicon]


def emissions(model: Model, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    grams, word = features(b, start, end)
    at = np.stack([start, end], 1).reshape(-1)
    score = model.weights[0][grams[0]] + model.weights[1][grams[1]]
    score += model.weights[2][grams[2]]
    score = np.concatenate([score, np.zeros((1, len(model.langs)), np.float32)])
    out = np.add.reduceat(score, at, axis=0)[::2] if len(at) else np.zeros((0, len(model.langs)), np.float32)
    for w, ids in zip(model.weights[3:], word):
        out += w[ids]
    return out


def _carried(e: np.ndarray, live: np.ndarray, t: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages between the blocks of a chain: forward into each block from the one before, and
    backward to its last word from the one after. A block as a whole is a k x k matrix; the
    blocks of all chains are walked rank by rank."""
    steps, n, k = e.shape
    into, after = np.ones((n, k), np.float32), np.ones((n, k), np.float32)
    many = np.flatnonzero(linked | np.append(linked[1:], False))
    if not len(many):
        return into, after
    m = np.where(linked[many, None, None], t[None], 1) * e[0, many, None, :]
    for i in range(steps):
        new = m if not i else (m.reshape(-1, k) @ t).reshape(-1, k, k) * e[i, many, None, :]
        m = np.where(live[i, many, :, None], new / new.sum((1, 2), keepdims=True), m)
    whole = np.empty((n, k, k), np.float32)
    whole[many] = m
    first = np.maximum.accumulate(np.where(linked, 0, np.arange(n)))
    rank = np.arange(n) - first
    order = np.argsort(rank, kind="stable")
    ranks = np.split(order, np.flatnonzero(np.diff(rank[order])) + 1)
    for at in ranks[1:]:
        v = np.where(linked[at - 1, None], np.einsum("nx,nxy->ny", into[at - 1], whole[at - 1]), whole[at - 1, 0])
        into[at] = v / v.sum(1, keepdims=True)
    for at in ranks[:0:-1]:
        v = np.einsum("nxy,ny->nx", whole[at], after[at])
        after[at - 1] = v / v.sum(1, keepdims=True)
    return into, after


def posterior(emit: np.ndarray, chain: np.ndarray, place: np.ndarray, trans: np.ndarray, linked: np.ndarray | None = None):
    """Forward-backward over all blocks at once: word marginals, and expected transitions. A
    linked block goes on with the chain of the block before; what it carries is exact."""
    k, n = emit.shape[1], int(chain[-1]) + 1 if len(chain) else 0
    steps = int(place.max()) + 1 if len(place) else 0
    if not n:
        return np.zeros((0, k), np.float32), np.zeros((k, k))
    linked = np.zeros(n, bool) if linked is None else linked
    e = np.ones((steps, n, k), np.float32)
    live = np.zeros((steps, n, 1), bool)
    e[place, chain] = np.exp(emit - emit.max(1, keepdims=True))
    live[place, chain] = True
    t = np.exp(trans - trans.max()).astype(np.float32)
    into, after = _carried(e, live, t, linked)
    fwd = np.empty_like(e)
    a = np.where(linked[:, None], into @ t, 1) * e[0]
    a /= a.sum(1, keepdims=True)
    for i in range(steps):
        if i:
            new = (a @ t) * e[i]
            new /= new.sum(1, keepdims=True)
            a = np.where(live[i], new, a)
        fwd[i] = a
    back = after
    pair = np.zeros((k, k))
    for i in range(steps - 1, -1, -1):
        if i < steps - 1:
            eb = e[i + 1] * back
            on = live[i + 1]
            new = eb @ t.T
            z = (fwd[i] * new).sum(1, keepdims=True)
            pair += t * (np.where(on, fwd[i] / z, 0).T @ eb)
            back = np.where(on, new / new.sum(1, keepdims=True), back)
        fwd[i] *= back
    eb = (e[0] * back)[linked]
    z = (into[linked] * (eb @ t.T)).sum(1, keepdims=True)
    pair += t * ((into[linked] / z).T @ eb)
    m = fwd[place, chain]
    return m / m.sum(1, keepdims=True), pair


def chains(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's words are one chain, in blocks of CHAIN words: number of the block, place
    in it, and for each block whether it goes on with the one before."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], np.diff(doc) != 0]))
    place = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    return np.cumsum(place % CHAIN == 0) - 1, place % CHAIN, place[place % CHAIN == 0] > 0


def fit(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Maximum likelihood by AdaGrad. Chains are spliced from segments of different documents,
    so transitions between languages are learned too."""
    langs = sorted(set(labels))
    k, rng = len(langs), np.random.default_rng(seed)
    model = Model(langs, np.zeros((len(FAMILIES), 1 << BITS, k), np.float32), np.zeros((k, k), np.float32))
    segments = []
    for text, lab in zip(texts, labels):
        w = text.lower().split()
        for i in range(0, len(w), 24):
            segments.append((" ".join(w[i:i + 24]).encode("utf-8", "surrogatepass"), langs.index(lab)))
    rng.shuffle(segments)
    total_w, total_t = np.full(model.weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    per = max(1, min(1500, -(-len(segments) // 8)))
    for _ in range(epochs):
        for i in range(0, len(segments), per):
            part = segments[i:i + per]
            b = np.frombuffer(b"\n".join([*[s for s, _ in part], b""]), np.uint8)
            start, end = bh.words(b)
            ends = np.cumsum([len(s) + 1 for s, _ in part])
            seg = np.searchsorted(ends, start, side="right")
            gold = np.array([y for _, y in part])[seg]
            chain, place, linked = chains(seg // 3)  # three segments in a row
            m, pair = posterior(emissions(model, b, start, end), chain, place, model.trans, linked)
            err = -m
            err[np.arange(len(gold)), gold] += 1
            grams, word = features(b, start, end)
            owner = np.repeat(np.arange(len(start)), end - start)
            inside = np.concatenate([np.arange(s, e) for s, e in zip(start, end)]) if len(start) else np.zeros(0, np.int64)
            for f in range(len(FAMILIES)):
                ids, who = (grams[f][inside], owner) if f < 3 else (word[f - 3], np.arange(len(start)))
                for y in range(k):
                    g = np.bincount(ids, err[who, y], 1 << BITS).astype(np.float32) / len(part)
                    total_w[f, :, y] += g * g
                    model.weights[f, :, y] += 0.1 * g / np.sqrt(total_w[f, :, y])
            seen = np.zeros((k, k))
            inner = (place[1:] > 0) | linked[chain[1:]]
            np.add.at(seen, (gold[:-1][inner], gold[1:][inner]), 1)
            g = (seen - pair) / len(part)
            total_t += g * g
            model.trans += (0.2 * g / np.sqrt(total_t)).astype(np.float32)
    return model


def label_words(model: Model, text: str) -> list[tuple[str, str, float]]:
    """(word, language, posterior) of each word of one text."""
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    start, end = bh.words(b)
    chain, place, linked = chains(np.zeros(len(start), np.int64))
    m, _ = posterior(emissions(model, b, start, end), chain, place, model.trans, linked)
    raw = b.tobytes()
    return [(raw[s:e].decode("utf-8", "replace"), model.langs[y], float(p[y])) for s, e, p, y in zip(start, end, m, m.argmax(1) if len(m) else [])]


def predict(model: Model | None, texts: list) -> tuple[list[str], list[float]]:
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if model is None or not model.langs:
        return langs, scores
    lettered = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    for first, b, starts in bh.chunks([texts[i].lower() for i in lettered]):
        start, end = bh.words(b)
        doc = np.searchsorted(starts, start, side="right") - 1
        chain, place, linked = chains(doc)
        m, _ = posterior(emissions(model, b, start, end), chain, place, model.trans, linked)
        n = len(starts) - 1
        mass = np.stack([np.bincount(doc, m[:, y], n) for y in range(len(model.langs))], 1)
        share = mass / np.maximum(mass.sum(1, keepdims=True), 1e-9)
        for j, y in enumerate(share.argmax(1)):
            i = lettered[first + j]
            langs[i], scores[i] = model.langs[y], round(min(1.0, float(share[j, y])), 6)
    return langs, scores


def held_out(doc_id):
    """crc32 of the id as text, mod 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Fits on the driver: at most per_lang x languages rows of SAMPLE_CHARS characters come there."""
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    rows = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") <= SAMPLE_CHARS))
            .select("lang", "doc_id", "text", F.md5(F.col("doc_id").cast("string")).alias("h"))
            .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_lang).select("lang", "n", "text").collect())
    rows.sort(key=lambda r: (r.lang, r.n))
    return fit([r.text for r in rows], [r.lang for r in rows]) if rows else None


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of docs, held_out, lang_pred and score. The model's size is fixed by
    BITS and the number of languages, whatever the corpus."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    text = free_name(docs, "text")
    src = long_rows(docs).select(*keep, F.col("text").alias(text), held_out(F.col("doc_id")).alias("held_out"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != text) + ", lang_pred string, score double"

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                langs, scores = predict(held.value, part.column(text).to_pylist())
                names = [n for n in part.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    return src.mapInArrow(bh.lean(task), schema)


def kept_languages(docs: DataFrame, model: Model | None, least: float = NEAREST) -> DataFrame:
    """docs without those that have no language (`und`) or a score under `least`."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                langs, scores = predict(held.value, part.column("text").to_pylist())
                yield part.filter(pa.array([x != "und" and y >= least for x, y in zip(langs, scores)], pa.bool_()))

    return long_rows(docs).mapInArrow(bh.lean(task), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.withColumn("doc_id", F.col("doc_id").cast("long")), train(docs))


ORACLE_SQL = None  # held-out accuracy is tested
