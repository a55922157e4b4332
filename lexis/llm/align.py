"""Cross-tokenizer alignment (operator 13): which tokens of one tokenizer stand for which
tokens of another, text by text and over the whole corpus.

Both tokenizers' tokens are byte ranges of the same bytes.  Where a token of each ends at
the same byte there is a cut; between two cuts lies a group, and every token of A in it is
linked with every token of B in it.

All texts of a batch are merged in lockstep: one state vector holds, per text, the
current token of A and of B and the beginning of the open group.  In each step every text
advances the side whose token ends first, or both at a cut; cuts emit their groups, and
texts that are done are compacted out of the vector.  Long texts are cut into lanes of the
vector before single spaces between two other characters, where both tokenizers end a
token anyway (checked in B's vocabulary, and per lane; a text whose lanes do not add up is
merged whole).

Scale: texts are encoded once, without a shuffle; per text the ids of its distinct linked
pairs with their multiplicities are written.  Pairs are counted map-side first.  The most
frequent pairs, at most BROADCAST_PAIRS, are broadcast with their counts; what a text
has of the others is joined by shuffle, and as those are rare no key is hot.

Defined cases: a text that is null or empty, or whose bytes a tokenizer changes (it holds
U+2581, or is normalised), has no tokens: zeros and an empty string.  Null and repeated
doc_ids are rows like others.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.token_count import pieces
from lexis.session import scratch_path, ship_package, written

LANE = 1 << 10  # code points of a lane, about
GROUP_BYTES = 1 << 21  # UTF-8 bytes of the texts merged together
EXPAND = 1 << 21  # links expanded at once
WIDE_GROUP = 1 << 16  # links of a group whose equal tokens are combined first
BROADCAST_PAIRS = 1 << 20
_LOADED: dict = {}


def default_paths() -> tuple[str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# ---------------------------------------------------------------------------
# the two tokenizers
# ---------------------------------------------------------------------------

def _byte_of_symbol() -> dict:
    """Byte-level vocabularies write a printable Latin-1 byte as its own
    character and the others, in order, as characters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Bytes and decimal digits of every token, as flat arrays."""

    def __init__(self, tokens: list, encode):
        self.encode = encode  # list of texts -> list of lists of ids
        self.width = len(tokens)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.digits = np.char.zfill(np.arange(self.width).astype("S"), 6).view("S1").reshape(self.width, 6).view(np.uint8)

    def ids(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's begin (one entry more)."""
        found = self.encode(texts)
        first = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
        flat = np.fromiter((i for x in found for i in x), np.int64, first[-1])
        return flat, first

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = self.start[ids] - (np.cumsum(size) - size)
        return self.data[np.repeat(shift, size) + np.arange(int(size.sum()))]


def _merges_in_order(model: dict) -> bool:
    """True if every merge makes the next id after the 256 bytes, so that
    ids are ranks."""
    vocab = model["vocab"]
    for i, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        if vocab.get(a + b) != 256 + i:
            return False
    return True


def byte_level(path: str) -> Vocabulary:
    """A: a byte-level vocabulary file.  If its ids are ranks and its pattern
    is the usual one, its own ranks go to the faster of the two libraries."""
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    own.no_truncation()
    own.no_padding()
    with open(path, encoding="utf-8") as f:
        facts = json.load(f)
    byte = _byte_of_symbol()
    tokens: list = [b""] * own.get_vocab_size()
    for token, i in own.get_vocab().items():
        tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    split = facts.get("pre_tokenizer") or {}
    plain = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and facts.get("normalizer") is None
             and facts["model"].get("type", "BPE") == "BPE" and not facts["model"].get("ignore_merges"))
    if plain and _merges_in_order(facts["model"]):
        special = {x["id"] for x in facts.get("added_tokens", [])}
        ranks = {t: i for i, t in enumerate(tokens) if i not in special}
        fast = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Vocabulary(tokens, lambda texts: [fast.encode_ordinary(t) for t in texts])
    return Vocabulary(tokens, lambda texts: [x.ids for x in own.encode_batch_fast(texts, add_special_tokens=False)])


def pieces_of(path: str) -> tuple[Vocabulary, bool]:
    """B: a sentence-piece model, and whether none of its pieces goes on after a
    space that follows another character (texts may be cut before it)."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens, cuts = [], True
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        cuts &= "▁" not in piece.lstrip("▁")
        tokens.append(bytes([int(piece[3:5], 16)]) if own.is_byte(i) else piece.replace("▁", " ").encode())
    return Vocabulary(tokens, lambda texts: own.encode(texts, num_threads=1)), cuts


def vocabularies(paths: tuple) -> tuple:
    if paths not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[paths] = (byte_level(paths[0]), *pieces_of(paths[1]))
    return _LOADED[paths]


# ---------------------------------------------------------------------------
# merging
# ---------------------------------------------------------------------------

def lockstep(end_a, first_a, end_b, first_b):
    """Groups of all lanes: arrays (lane, a0, a1, b0, b1) of token ranges, in
    order.  ``end_*``: where each token ends, from the beginning of its lane;
    ``first_*``: where each lane's tokens begin.  The last tokens of a lane end
    together."""
    lanes = np.flatnonzero(first_a[1:] > first_a[:-1])
    # rows: lane, token of A, token of B, beginning of the open group in A, in B, end of the lane in A
    state = np.stack([lanes, first_a[lanes], first_b[lanes], first_a[lanes], first_b[lanes], first_a[lanes + 1]])
    out = []
    while state.shape[1]:
        a, b = end_a[state[1]], end_b[state[2]]
        state[1] += a <= b
        state[2] += b <= a
        cut = np.flatnonzero(a == b)
        if len(cut):
            here = state[:, cut]
            out.append(here[[0, 3, 1, 4, 2]])
            state[3, cut], state[4, cut] = here[1], here[2]
            going = state[1] < state[5]
            if not going.all():
                state = state[:, going]
    groups = np.concatenate(out, axis=1) if out else np.zeros((5, 0), np.int64)
    return groups[:, np.argsort(groups[1], kind="stable")]


def _in_lane(vocabulary: Vocabulary, ids, first):
    """End of every token from the beginning of its lane, and lane lengths."""
    ends = np.concatenate([[0], np.cumsum(vocabulary.size[ids])])
    base = ends[first]
    return ends[1:] - np.repeat(base[:-1], np.diff(first)), np.diff(base)


def _links(groups, doc, a_ids, b_ids, width: int):
    """(doc, pair, times): distinct linked id pairs of each document, ascending;
    a pair is ``a * width + b``."""
    _, a0, a1, b0, b1 = groups
    p, q = a1 - a0, b1 - b0
    found, held = [], []

    def settle(keys, times):
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[begin], np.add.reduceat(times, begin) if len(begin) else times

    wide = p * q > WIDE_GROUP
    normal = np.flatnonzero(~wide)
    ends = np.cumsum((p * q)[normal])
    for i in range(0, int(ends[-1]) if len(ends) else 0, EXPAND):
        part = normal[np.searchsorted(ends, i, "right"):np.searchsorted(ends, i + EXPAND, "right")]
        n = (p * q)[part]
        at = np.repeat(part, n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        key = (doc[at] << 32) | (a_ids[a0[at] + k // q[at]] * width + b_ids[b0[at] + k % q[at]])
        keys, times = settle(key, np.ones(len(key), np.int64))
        found.append(keys)
        held.append(times)
    for g in np.flatnonzero(wide):
        ua, na = np.unique(a_ids[a0[g]:a1[g]], return_counts=True)
        ub, nb = np.unique(b_ids[b0[g]:b1[g]], return_counts=True)
        rows = max(1, EXPAND // len(ub))
        for i in range(0, len(ua), rows):
            found.append(((doc[g] << 32) | (ua[i:i + rows, None] * width + ub)).ravel())
            held.append((na[i:i + rows, None] * nb).ravel())
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, times = settle(np.concatenate(found), np.concatenate(held))
    return keys >> 32, keys & 0xFFFFFFFF, times


def _digests(groups, doc, n_docs, a_ids, b_ids, a_vocab, b_vocab):
    """SHA-256 per document of its groups written as ``a1,a2|b1;a3|b2,b3``."""
    _, a0, a1, b0, b1 = groups
    p, q = a1 - a0, b1 - b0
    na, nb = int(p.sum()), int(q.sum())
    # groups lie one after another: the tokens of all groups before one precede its own
    a_before, b_before = np.cumsum(p) - p, np.cumsum(q) - q
    a_from = np.repeat(a0 - a_before, p) + np.arange(na)
    b_from = np.repeat(b0 - b_before, q) + np.arange(nb)
    a_to = np.arange(na) + np.repeat(b_before, p)
    b_to = np.arange(nb) + np.repeat(a_before + p, q)
    cells = np.zeros((na + nb, 7), np.uint8)
    cells[a_to, :6], cells[b_to, :6] = a_vocab.digits[a_ids[a_from]], b_vocab.digits[b_ids[b_from]]
    cells[:, 6] = ord(",")
    ends = np.cumsum(p + q)
    cells[ends - q - 1, 6] = ord("|")
    cells[ends - 1, 6] = ord(";")
    keep = np.ones_like(cells, bool)
    keep[:, :6] = np.logical_or.accumulate(cells[:, :6] != ord("0"), axis=1)
    keep[:, 5] = True  # the number 0 itself
    flat = cells[keep].tobytes()
    written_to = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
    tokens = np.bincount(doc, weights=p + q, minlength=n_docs).astype(np.int64)
    bound = written_to[np.concatenate([[0], np.cumsum(tokens)])]
    return ["" if b == a else hashlib.sha256(flat[a:b - 1]).hexdigest() for a, b in zip(bound[:-1], bound[1:])]


def merge(texts: list, paths: tuple, split: bool = True) -> list:
    """Per text (n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), the last two
    as arrays: its distinct linked id pairs and how often each is linked."""
    a_vocab, b_vocab, cuts = vocabularies(paths)
    nothing = (0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int32))
    out = [nothing] * len(texts)
    lanes, owner = [], []
    for i, text in enumerate(texts):
        if text:
            parts = pieces(text, LANE) if split and cuts else [text]
            lanes.append(" " + parts[0])
            lanes.extend(parts[1:])  # each begins with its space
            owner.extend([i] * len(parts))
    if not lanes:
        return out
    a_ids, a_first = a_vocab.ids(lanes)
    b_ids, b_first = b_vocab.ids([x[1:] for x in lanes])
    (a_end, a_size), (b_end, b_size) = _in_lane(a_vocab, a_ids, a_first), _in_lane(b_vocab, b_ids, b_first)
    raw = [x.encode() for x in lanes]
    size = np.array([len(x) for x in raw], np.int64)
    owner = np.array(owner, np.int64)
    good = (a_size == size) & (b_size == size)
    if good.all():
        own = np.frombuffer(b"".join(raw), np.uint8)
        differ = (a_vocab.bytes_of(a_ids) != own) | (b_vocab.bytes_of(b_ids) != own)
        good = np.add.reduceat(differ, np.cumsum(size) - size, dtype=np.int64) == 0
    if not good.all():
        bad = np.unique(owner[~good])
        left = [i for i in np.unique(owner).tolist() if i not in set(bad.tolist())]
        for i, found in zip(left, merge([texts[i] for i in left], paths, split)):
            out[i] = found
        if split and cuts:  # judged by their whole texts
            for i in bad.tolist():
                out[i] = merge([texts[i]], paths, False)[0]
        return out
    groups = lockstep(a_end, a_first, b_end, b_first)
    doc = owner[groups[0]]
    n = len(texts)
    p, q = groups[2] - groups[1], groups[4] - groups[3]

    def total(x):
        return np.bincount(doc, weights=x, minlength=n).astype(np.int64)

    n_a, n_b, n_groups, n_links = total(p), total(q), np.bincount(doc, minlength=n), total(p * q)
    digests = _digests(groups, doc, n, a_ids, b_ids, a_vocab, b_vocab)
    of, pair, times = _links(groups, doc, a_ids, b_ids, b_vocab.width)
    at = np.searchsorted(of, np.arange(n + 1))
    for i in np.unique(owner).tolist():
        part = slice(at[i], at[i + 1])
        out[i] = (int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), digests[i],
                  pair[part].astype(np.int32), times[part].astype(np.int32))
    return out


def batches_by_bytes(texts: list, limit: int = GROUP_BYTES):
    """Ranges of rows whose texts hold about ``limit`` bytes together."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text.encode()) if text else 0
        if held >= limit:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def merged(docs: DataFrame, paths: tuple) -> DataFrame:
    """The merge of every row: row (a number of its own), doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256, pairs and times."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = "row bigint, doc_id " + kind + ", n_a bigint, n_b bigint, n_groups bigint, n_links bigint, " \
             "groups_sha256 string, pairs array<int>, times array<int>"
    names = [x.strip().split(" ")[0] for x in fields.split(",")]

    def lists(arrays):
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32)))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in batches_by_bytes(texts):
                cols = list(zip(*merge(texts[a:b], paths)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), batch.column("doc_id").slice(a, b - a),
                     *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                     lists(cols[5]), lists(cols[6])], names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, fields)


# ---------------------------------------------------------------------------
# counts of the corpus
# ---------------------------------------------------------------------------

def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): in how many rows a pair is linked, and whether no
    other pair of the same A id is in more."""
    n = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {width}"))  # at most ``width`` pairs
    return n.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def frequent(counts: DataFrame, limit: int) -> int:
    """The least count of a pair to be broadcast: as low as leaves at most
    ``limit`` pairs, by a histogram of eighths of a power of two."""
    step = F.floor(F.log2("n") * 8)
    held, least = 0, None
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")) \
            .orderBy(F.desc("step")).collect():
        held += r["pairs"]
        if held > limit:
            break
        least = r["least"]
    return least if least is not None else (1 << 62)


def alignments(docs: DataFrame, paths: tuple | None = None, limit: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256."""
    spark = docs.sparkSession
    ship_package(spark)
    paths = tuple(paths or default_paths())
    at = scratch_path(spark, "merged")
    merged(docs, paths).write.option("compression", "zstd").parquet(at)
    rows = spark.read.parquet(at)
    counts = written(pair_counts(rows, vocabularies(paths)[1].width), "pairs")
    least = frequent(counts, limit)
    top = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(top.column("pair").to_numpy())
    known = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = "row bigint, doc_id " + kind + ", n_a bigint, n_b bigint, n_groups bigint, n_links bigint, " \
             "groups_sha256 string, n_best bigint, count_sum bigint, rare array<struct<pair: int, times: int>>"

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            bound = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            hit, place = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
            if len(pair):
                place = np.minimum(np.searchsorted(pair, keys), len(pair) - 1)
                hit = pair[place] == keys

            def total(x):
                ends = np.concatenate([[0], np.cumsum(x)])
                return pa.array(ends[bound[1:]] - ends[bound[:-1]], pa.int64())

            n_best = total(np.where(hit & best[place], times, 0) if len(pair) else np.zeros(len(keys), np.int64))
            sums = total(np.where(hit, n[place] * times, 0) if len(pair) else np.zeros(len(keys), np.int64))
            missed = np.concatenate([[0], np.cumsum(~hit)])[bound].astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(keys[~hit], pa.int32()), pa.array(times[~hit].astype(np.int32))],
                                              ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")],
                 n_best, sums, pa.ListArray.from_arrays(pa.array(missed), rare)],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rare"])

    out = rows.mapInArrow(run, fields)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rest = counts.where(F.col("n") < least)
    if rest.isEmpty():
        return out.select(*names)
    out = written(out, "aligned")
    more = out.select("row", F.inline("rare")).join(rest, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    return out.drop("rare").join(more, "row", "left") \
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))) \
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*names)
