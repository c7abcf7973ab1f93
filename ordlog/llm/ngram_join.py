"""Documents whose sets of word shingles are alike: an exact Jaccard self-join.

Two documents link when 100 * |intersection| >= 75 * |union| of their distinct 5-word
shingles (64-bit hashes). The result has one row for each document, with its class: all
that can be reached over links. Copies are one node of the graph, so they are never paired.

1. Every set gets a 128-bit digest; documents with equal sets share one class.
2. A first filter. Ordered by hash, the first n - o + k shingles of a set of n that must
   share o with a partner hold at least k shared ones, and so do the partner's. Counting in
   how many sets such a prefix shingle stands leaves only documents with enough shared ones.
3. For these, the sets are made again and all shingles counted. A document of which less
   than three quarters of the shingles stand elsewhere has no link.
4. Token-combination prefixes. Shingles are ordered by the number of sets that hold them,
   rarest first. Rare ones are signatures by themselves. Frequent ones are dealt into
   classes by hash, and pairs of shingles of a class are signatures; since one shared
   shingle of a class then shows nothing, the prefix is extended until its shingles, less
   one for each class of frequent ones, are more than the ones a partner may lack. Linked
   documents share a signature. Documents of lengths that fit use the same classes.
   Of n shingles of which m stand elsewhere, a document shares m at most, and so links with
   none of more than 7/3 m - n shingles. Documents that in this way could link with no other
   of their signature are not looked at further.
5. Documents of a signature become candidates: all pairs of up to ``few``, of more only those
   next to each other by size and by name. Candidates are verified on their whole sets.
6. What is left: signatures of more than ``few`` documents that lie in several components so
   far. Their documents are compared block by block (no pair within a component, none of
   sizes that can't link), by a product of 0/1 matrices. This settles every candidate pair.

Shingles travel packed: a task sends each bucket one row with many shingles. Shingles that
stand in a hundredth of all documents or more are found beforehand, task by task, and are
known to be shared without being sent, so no bucket gets a hot one's documents.

Nulls and texts without words have no shingles, are alone in their class and link with
nothing. Very long texts give their whole set, in one task. Copies are ties: one class,
named by its smallest id. Of rows with a null id the class id is that of the smallest id
linked with them, null if there is none. Repeated ids are separate rows. Only id and text
are read, so other columns are not in the way. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordlog.llm import words
from ordlog.llm.components import components
from ordlog.llm.shared import BROADCAST_ROWS, stage, tidy

SHINGLE = 5
NEED, OF = 75, 100  # share of the union that must be common
SPARE = 10  # percent of a set by which the first filter's prefixes are longer than need be
CHUNK = 1 << 20  # shingles a task gathers before it deals them
ROWS = 1 << 17  # rows a task hands on at once
BROADCAST_IDS = 2_000_000  # numbers of 8 bytes, some 50 MB as a hash table
SHARE_BLOCKS = 64  # blocks that one task deals out
HOT_CLASSES = 1000  # a class with more than one of so many rows is large; no more are
STEP = np.log(OF / NEED)


@dataclass(frozen=True)
class Limits:
    """What decides on the way taken, never on the result."""

    bucket: int = 1 << 21  # shingles of a bucket
    hot_share: int = 128  # a shingle in more than one of so many documents is hot
    hot_least: int = 32
    frequent: int = 16  # sets that hold a frequent shingle
    few: int = 16  # documents of a signature that are paired with each other
    salt_rows: int = 4096  # documents of a signature that meet in one place
    compared: int = 128  # documents of a block


DEFAULT = Limits()


def _common(n):
    """Shingles that a set of n must share with any partner."""
    return -(-n * NEED // OF)


def _largest(n, m):
    """The size of the largest set that one of n can link with, if m of its shingles stand in
    other sets at all: it shares m of them at most."""
    return (OF + NEED) * m // NEED - n


# --- shingles of texts -----------------------------------------------------------------


def _sets(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    for i, _, w in words.split_texts(batch.column(text), words.SPACED):
        yield i, words.shingle_sets(w, SHINGLE)


def _digest(s: np.ndarray) -> tuple[int, int]:
    a, b = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist()
    return a, b


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, a, b = [], [], []
        for _, sets in _sets(batch, "text"):
            n += [len(s) for s in sets]
            pairs = [_digest(s) for s in sets]
            a += [x for x, _ in pairs]
            b += [x for _, x in pairs]
        kind = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, kind), pa.array(a, kind), pa.array(b, kind)],
            names=["id", "n", "d1", "d2"],
        )


def _hot(share: int):
    """Shingles that many of the task's documents have, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        docs = 0
        for batch in batches:
            for _, sets in _sets(batch, "text"):
                docs += len(sets)
                every = np.concatenate([*sets, np.empty(0, np.uint64)])
                every.sort()
                at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
                count = np.diff(np.r_[at, len(every)])
                many = count >= max(3, len(sets) // share)
                sums.update(dict(zip(every[at[many]].view(np.int64).tolist(), count[many].tolist())))
        kept = {t: c for t, c in sums.items() if c * share >= docs}
        yield pa.RecordBatch.from_pydict(
            {"token": pa.array(list(kept), pa.int64()), "docs": pa.array(list(kept.values()), pa.int64())}
        )

    return tidy(run)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


# --- packed rows: shingles dealt by bucket ----------------------------------------------

PACKED = "part int, owners binary, counts binary, tokens binary, extra binary"


def _packed(part: np.ndarray, owner: np.ndarray, token: np.ndarray, extra: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each part: its owners (runs of one owner as a number), tokens, extras."""
    order = np.argsort(part, kind="stable")
    part, owner, token, extra = part[order], owner[order], token[order], extra[order]
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    rows = []
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(part)]):
        runs = np.flatnonzero(np.r_[True, owner[a + 1 : b] != owner[a : b - 1]])
        counts = np.diff(np.r_[runs, b - a]).astype("<i4")
        rows.append(
            (
                int(part[a]),
                owner[a:b][runs].tobytes(),
                counts.tobytes(),
                token[a:b].tobytes(),
                extra[a:b].astype("<i4").tobytes(),
            )
        )
    if rows:
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["part", "owners", "counts", "tokens", "extra"],
        )


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = {c: b"".join(table.column(c).to_pylist()) for c in ("owners", "counts", "tokens", "extra")}
    owner = np.repeat(np.frombuffer(raw["owners"], "<i8"), np.frombuffer(raw["counts"], "<i4"))
    return owner, np.frombuffer(raw["tokens"], "<u8"), np.frombuffer(raw["extra"], "<i4")


def _grouped(owner: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (token, owner) pairs and in how many owners each token stands."""
    order = np.lexsort((owner, token))
    owner, token = owner[order], token[order]
    if len(token):
        new = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])]
        owner, token = owner[new], token[new]
    at = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.empty(0, np.int64)
    held = np.diff(np.r_[at, len(token)])
    return owner, token, np.repeat(held, held)


# --- 2: the first filter ---------------------------------------------------------------


def _prefixes(buckets: int, hot):
    """Prefixes by hash, dealt by shingle; the extra of hot ones is their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = hot.value[0], set()
        owners, tokens, size = [], [], 0

        def deal():
            token = np.concatenate(tokens)
            owner = np.repeat(np.array([o for o, _ in owners], np.int64), [c for _, c in owners])
            known = _member(token, table)
            # hot shingles are not sent; their number goes with the owner to any bucket
            who, many = np.unique(owner[known], return_counts=True)
            yield from _packed(
                np.r_[(token[~known] % np.uint64(buckets)).astype(np.int64), who % buckets],
                np.r_[owner[~known], who],
                np.r_[token[~known], np.zeros(len(who), np.uint64)],
                np.r_[np.zeros((~known).sum(), np.int64), many],
            )

        for batch in batches:
            for _, sets in _sets(batch, "text"):
                for s in sets:
                    if not len(s):
                        continue
                    name = _digest(s)[0]
                    if name in seen:
                        continue
                    if len(seen) >= 1 << 20:
                        seen.clear()
                    seen.add(name)
                    n = len(s)
                    prefix = s[: n - _common(n) + max(1, -(-n * SPARE // 100))]
                    owners.append((name, len(prefix)))
                    tokens.append(prefix)
                    size += len(prefix)
                    if size >= CHUNK:
                        yield from deal()
                        owners, tokens, size = [], [], 0
        if tokens:
            yield from deal()

    return tidy(run)


def _shared_counts(table: pa.Table) -> pa.Table:
    owner, token, known = _unpacked(table)
    sent = known == 0
    who, _, held = _grouped(owner[sent], token[sent])
    who = np.r_[who[held >= 2], np.repeat(owner[~sent], known[~sent])]
    name, many = np.unique(who, return_counts=True)
    return pa.table({"d1": pa.array(name, pa.int64()), "shared": pa.array(many, pa.int64())})


def _enough(n: Column) -> Column:
    """Shared prefix shingles that a document with a link has at least.

    Of two linked prefixes the one that ends first has its spare ones in both; it may be
    the partner's, whose set is as small as three quarters of this one."""
    smallest = F.ceil(n * NEED / OF)
    return F.greatest(F.ceil(smallest * SPARE / 100), F.lit(1))


# --- 3: all shingles of the documents that are left ------------------------------------


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets in _sets(batch, "text"):
            sets = [s for s in sets if len(s)]
            names = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a for a, _ in names], pa.int64()),
                    pa.array([b for _, b in names], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["d1", "d2", "tokens"],
            )


def _deal(buckets: int, hot):
    """All shingles dealt by bucket; hot ones go straight to their owner's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hot.value[0]
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                cls = batch.column("cls").slice(a, 512).to_numpy()
                sets = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("tokens").slice(a, 512)]
                token = np.concatenate([*sets, np.empty(0, np.uint64)])
                owner = np.repeat(cls, [len(s) for s in sets])
                sent = ~_member(token, table)
                part = (token[sent] % np.uint64(buckets)).astype(np.int64)
                yield from _packed(part, owner[sent], token[sent], np.zeros(len(part), np.int64))

    return tidy(run)


def _hot_of(parts: int, hot):
    """The hot shingles of each document, with their number, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, docs = hot.value
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), "<u8") for x in batch.column("tokens")]
            sets = [s[_member(s, table)] for s in sets]
            token = np.concatenate([*sets, np.empty(0, np.uint64)])
            owner = np.repeat(cls, [len(s) for s in sets])
            if len(token):
                yield from _packed(owner % parts, owner, token, docs[np.searchsorted(table, token)])

    return tidy(run)


def _shared(parts: int):
    def run(table: pa.Table) -> pa.Table:
        owner, token, _ = _unpacked(table)
        owner, token, held = _grouped(owner, token)
        keep = held >= 2
        owner, token, held = owner[keep], token[keep], held[keep]
        order = np.argsort(owner, kind="stable")
        owner, token, held = owner[order], token[order], held[order]
        rows = list(_packed(owner % parts, owner, token, held))
        return pa.Table.from_batches(rows) if rows else _no_packed()

    return run


def _no_packed() -> pa.Table:
    names = ["owners", "counts", "tokens", "extra"]
    return pa.table({"part": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in names}})


def _ordered(table: pa.Table) -> pa.Table:
    """Each document's shared shingles, rarest first, and in how many sets they stand."""
    owner, token, held = _unpacked(table)
    order = np.lexsort((token, held, owner))
    owner, token, held = owner[order], token[order], held[order]
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
    end = np.r_[at[1:], len(owner)]
    return pa.table(
        {
            "cls": pa.array(owner[at], pa.int64()),
            "m": pa.array(end - at, pa.int64()),
            "tokens": pa.array([token[a:b].tobytes() for a, b in zip(at, end)], pa.binary()),
            "held": pa.array([held[a:b].astype("<i4").tobytes() for a, b in zip(at, end)], pa.binary()),
        }
    )


# --- 4: signatures ---------------------------------------------------------------------


def _schemes(n: int) -> tuple[int, int]:
    """A document of n shingles and any partner have one of their schemes in common."""
    step = int(np.floor(np.log(n) / STEP + 1e-9))
    return step, step + 1


def _classes(scheme: int) -> int:
    """Classes of frequent shingles: some six of a prefix fall into each; 0: the documents
    are so small that single shingles are used throughout."""
    n = (OF / NEED) ** scheme
    return 0 if n < 12 else max(1, round(n * (1 - NEED / OF) / 6))


def _signatures(
    n: int, token: np.ndarray, held: np.ndarray, scheme: int, often: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the prefix' signatures, and about how many documents have them."""
    lacking = n - _common(n) - (n - len(token))  # of these shingles, what a partner may lack
    classes = _classes(scheme)
    frequent = (held >= often) if classes else np.zeros(len(token), bool)
    rare = int(np.argmax(frequent)) if frequent.any() else len(token)
    if rare > lacking:
        yield words.mixed(token[: lacking + 1]), held[: lacking + 1]
        return
    if rare:
        yield words.mixed(token[:rare]), held[:rare]
    # the first shingle of a class shows nothing, each further one counts
    kind = (words.mixed(token[rare:] + np.uint64(1)) % np.uint64(classes)).astype(np.int64)
    order = np.argsort(kind, kind="stable")
    first = np.zeros(len(kind), bool)
    first[order[np.flatnonzero(np.r_[True, kind[order][1:] != kind[order][:-1]])]] = True
    counted = np.cumsum(~first)
    needed = lacking + 1 - rare
    if counted[-1] < needed:  # a class for each: singles in the place of pairs
        raise AssertionError("a prefix can't be long enough")
    size = int(np.searchsorted(counted, needed)) + 1
    token, held, kind = token[rare : rare + size], held[rare : rare + size], kind[:size]
    for c in np.unique(kind).tolist():
        t, h = token[kind == c], held[kind == c]
        a, b = np.triu_indices(len(t), 1)
        if len(a):
            low, high = np.minimum(t[a], t[b]), np.maximum(t[a], t[b])
            yield words.mixed(words.mixed(low) + high + np.uint64(scheme)), np.minimum(h[a], h[b])


INDEX = "sig bigint, salt bigint, split boolean, cls bigint, n bigint, most bigint"
INDEX_COLUMNS = [c.split()[0] for c in INDEX.split(", ")]


def _prefix_index(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, owners, rows = [], [], [], 0

        def shown() -> pa.RecordBatch:
            name, many = np.concatenate(names), np.concatenate(counts).astype(np.int64)
            cls = np.repeat([o for o, *_ in owners], [k for *_, k in owners]).astype(np.int64)
            n = np.repeat([size for _, size, _, _ in owners], [k for *_, k in owners]).astype(np.int64)
            salts = np.maximum(1, -(-many // limits.salt_rows))
            most = np.repeat([m for _, _, m, _ in owners], [k for *_, k in owners]).astype(np.int64)
            columns = [name.view(np.int64), cls % salts, salts > 1, cls, n, most]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=INDEX_COLUMNS)

        for batch in batches:
            for cls, n, tokens, held in zip(*(batch.column(c) for c in ("cls", "n", "tokens", "held"))):
                n = n.as_py()
                token, held = np.frombuffer(tokens.as_buffer(), "<u8"), np.frombuffer(held.as_buffer(), "<i4")
                found = [x for k in _schemes(n) for x in _signatures(n, token, held, k, limits.frequent)]
                name, first = np.unique(np.concatenate([x for x, _ in found]), return_index=True)
                names.append(name)
                counts.append(np.concatenate([x for _, x in found])[first])
                owners.append((cls.as_py(), n, _largest(n, len(token)), len(name)))
                rows += len(name)
                if rows >= ROWS:
                    yield shown()
                    names, counts, owners, rows = [], [], [], 0
        if rows:
            yield shown()

    return tidy(run)


# --- 5: candidates ---------------------------------------------------------------------


def _pairs(few: int):
    """Candidates (kind 0) and members of signatures that not all are paired of (kind 1)."""
    return lambda table: _paired(table, few)


def _paired(table: pa.Table, few: int) -> pa.Table:
    rows = [table.column(c).to_numpy(zero_copy_only=False) for c in INDEX_COLUMNS]
    sig, salt, split, cls, n, most = rows
    order = np.lexsort((cls, n, salt, sig))
    while True:
        sig, salt, split, cls, n, most = (c[order] for c in (sig, salt, split, cls, n, most))
        bounds = np.flatnonzero(np.r_[True, (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1]), True]) if len(sig) else np.zeros(1, np.int64)
        size = np.diff(bounds)
        # a document that could link with none as large as its group's smallest one is out;
        # of a group dealt over several places the smallest one isn't known here
        order = np.flatnonzero((most >= np.repeat(n[bounds[:-1]], size)) | split)
        if len(order) == len(sig):
            break
    left, right, kept = [], [], []
    # pairs at each distance within a group, all groups of a size that allows it at once
    for gap in range(1, few):
        small = np.flatnonzero((size > gap) & (size <= few))
        if len(small):
            a = np.concatenate([np.arange(bounds[g], bounds[g + 1] - gap) for g in small.tolist()])
            left.append(a)
            right.append(a + gap)
    large = np.flatnonzero((size > few) | split[bounds[:-1]]) if len(size) else []
    for g in large:
        here = np.arange(bounds[g], bounds[g + 1])
        by_name = here[np.argsort(cls[here])]
        for row in (here, by_name):
            left.append(row[:-1])
            right.append(row[1:])
        kept.append(here)
    a = np.concatenate([*left, np.empty(0, np.int64)]).astype(np.int64)
    b = np.concatenate([*right, np.empty(0, np.int64)]).astype(np.int64)
    fits = (n[a] <= most[b]) & (n[b] <= most[a])
    x, y = np.minimum(cls[a], cls[b])[fits], np.maximum(cls[a], cls[b])[fits]
    pairs = np.unique(np.stack([x, y]), axis=1) if len(x) else np.empty((2, 0), np.int64)
    at = np.concatenate([*kept, np.empty(0, np.int64)]).astype(np.int64)
    return pa.table(
        {
            "kind": pa.array(np.r_[np.zeros(pairs.shape[1], np.int64), np.ones(len(at), np.int64)], pa.int32()),
            "a": pa.array(np.r_[pairs[0], sig[at]], pa.int64()),
            "b": pa.array(np.r_[pairs[1], cls[at]], pa.int64()),
        }
    )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, m, s, t in zip(*(batch.column(c) for c in ("na", "nb", "ta", "tb"))):
            s, t = np.frombuffer(s.as_buffer(), "<u8"), np.frombuffer(t.as_buffer(), "<u8")
            both = np.concatenate([s, t])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(OF * common >= NEED * (n.as_py() + m.as_py() - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


# --- 6: what is left of large signatures -----------------------------------------------


def _compare(table: pa.Table) -> pa.Table:
    """Links between the documents of two blocks (side 0 and 1; a block with itself: 2)."""
    side, cls, n, label = (table.column(c).to_numpy() for c in ("side", "cls", "n", "label"))
    tokens = [np.frombuffer(x, "<u8") for x in table.column("tokens").to_pylist()]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    every = np.concatenate([*tokens, np.empty(0, np.uint64)])
    _, column = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        ones = np.zeros((len(tokens), width), np.float32)
        ones[row[a:b], column[a:b] - first] = 1
        common += ones[left] @ ones[right].T
    union = n[left][:, None] + n[right][None, :] - common
    linked = (OF * common >= NEED * union) & (label[left][:, None] != label[right][None, :])
    a, b = np.nonzero(linked)
    return pa.table({"a": pa.array(cls[left[a]], pa.int64()), "b": pa.array(cls[right[b]], pa.int64())})


def _rest(members: DataFrame, labels: DataFrame, kept: DataFrame, compared: int) -> DataFrame | None:
    """Links between components among the documents of large signatures."""
    of = labels.select(F.col("node").alias("_node"), "label")
    sizes = kept.select("cls", "n", "most")
    known = members.join(sizes, "cls").join(of, F.col("cls") == F.col("_node"), "left")
    known = stage(known.select("sig", "cls", "n", "most", F.coalesce("label", "cls").alias("label")), "members")
    mixed = known.groupBy("sig").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least")
    )
    # those that could link with the signature's smallest document at least
    open_ = known.join(mixed.filter("low < high").select("sig", "least"), "sig").filter("most >= least")
    open_ = stage(open_.select("sig", "cls", "label"), "open")
    if not open_.limit(1).count():
        return None
    # documents that share a large signature, over any number of steps, are a family;
    # signatures are nodes too, told from documents by their sign
    graph = open_.select(F.col("cls").alias("a"), (-1 - F.abs(F.xxhash64("sig") / 2).cast("bigint")).alias("b"))
    families = components(graph).filter("node >= 0").select(F.col("node").alias("cls"), F.col("label").alias("family"))
    one = open_.groupBy("cls").agg(F.min("label").alias("label"))
    docs = one.join(families, "cls").join(sizes, "cls")
    # blocks of one component where possible, so that most pairs of blocks need no look;
    # a family is cut by size into strips first, its documents are never in one place
    strip = F.floor(F.log("n") / F.lit(float(STEP)) + F.lit(1e-9)).cast("int")
    place = Window.partitionBy("family", "strip", "share").orderBy("label", "n", "cls")
    docs = docs.withColumn("strip", strip)
    # the documents of a large component are dealt over as many shares as fill a block each,
    # small components over as many as one task takes of a strip
    of_label = docs.groupBy(F.col("label").alias("_label")).agg(F.count("*").alias("_docs"))
    of_strip = docs.groupBy(F.col("family").alias("_family"), F.col("strip").alias("_strip")).agg(F.count("*").alias("_wide"))
    sized = docs.join(of_label, F.col("label") == F.col("_label"))
    sized = sized.join(of_strip, (F.col("family") == F.col("_family")) & (F.col("strip") == F.col("_strip")))
    parts = F.greatest(F.ceil(F.col("_docs") / compared), F.lit(1))
    shares = F.greatest(F.ceil(F.col("_wide") / (compared * SHARE_BLOCKS)), F.lit(1))
    share = F.concat_ws("-", F.pmod(F.xxhash64("label"), shares), F.pmod(F.xxhash64("cls"), parts))
    placed = sized.select(*docs.columns, share.alias("share"))
    placed = placed.withColumn("block", F.floor((F.row_number().over(place) - 1) / compared))
    placed = stage(placed.withColumn("block", F.concat_ws(".", "strip", "share", "block")), "placed")
    blocks = placed.groupBy("family", "block").agg(
        F.min("n").alias("least"), F.max("most").alias("reach"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    other = blocks.select(*[F.col(c).alias(f"_{c}") for c in blocks.columns])
    pure = (F.col("low") == F.col("high")) & (F.col("_low") == F.col("_high")) & (F.col("low") == F.col("_low"))
    fits = (F.col("reach") >= F.col("_least")) & (F.col("_reach") >= F.col("least"))
    met = blocks.join(other, (F.col("family") == F.col("_family")) & (F.col("block") <= F.col("_block")) & fits & ~pure)
    met = stage(met.select("family", "block", "_block"), "met")
    both = [
        met.filter("block = _block").select("family", "block", "_block", F.col("block").alias("at"), F.lit(2).alias("side")),
        met.filter("block < _block").select("family", "block", "_block", F.col("block").alias("at"), F.lit(0).alias("side")),
        met.filter("block < _block").select("family", "block", "_block", F.col("_block").alias("at"), F.lit(1).alias("side")),
    ]
    wanted = both[0].unionAll(both[1]).unionAll(both[2])
    sets = placed.join(kept.select("cls", "tokens"), "cls").withColumnRenamed("family", "_family").withColumnRenamed("block", "_at")
    dealt = wanted.join(sets, (F.col("family") == F.col("_family")) & (F.col("at") == F.col("_at")))
    dealt = dealt.select("family", "block", "_block", "side", "cls", "n", "label", "tokens")
    return dealt.groupBy("family", "block", "_block").applyInArrow(_compare, "a bigint, b bigint")


# --- the whole -------------------------------------------------------------------------


def _partitions(spark, rows: int, each: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def linked_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """Digests of the rows (id, n, d1, d2), and of linked classes (d1, d2) the component."""
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = stage(read.mapInArrow(tidy(_digests), "id bigint, n bigint, d1 bigint, d2 bigint"), "digests")
    classes = stage(rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "classes")
    sizes = classes.agg(F.count("*").alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()

    found = read.select("text").mapInArrow(_hot(limits.hot_share), "token bigint, docs bigint").groupBy("token").agg(F.sum("docs").alias("docs"))
    floor = max(limits.hot_least, rows.count() // limits.hot_share)
    hot = sorted((r.token % (1 << 64), r.docs) for r in found.filter(F.col("docs") >= floor).collect())
    hot = np.array([t for t, _ in hot], np.uint64), np.array([min(d, 2**31 - 1) for _, d in hot], np.int64)
    shared = spark.sparkContext.broadcast(hot)

    buckets = _partitions(spark, sizes.tokens * (OF - NEED + SPARE) // 100, limits.bucket)
    dealt = read.select("text").mapInArrow(_prefixes(buckets, shared), PACKED)
    counts = dealt.groupBy("part").applyInArrow(_shared_counts, "d1 bigint, shared bigint")
    counts = counts.groupBy("d1").agg(F.sum("shared").alias("shared"))
    some = classes.join(counts, "d1").filter(F.col("shared") >= _enough(F.col("n")))
    some = stage(some.select("d1", "d2", "rep", "n", F.monotonically_increasing_id().alias("cls")), "survivors")
    n_some = some.count()

    ids = some.select(F.col("rep").alias("_rep")).distinct()
    ids = F.broadcast(ids) if n_some <= BROADCAST_IDS else ids
    again = read.join(ids, F.col("id").eqNullSafe(F.col("_rep")), "left_semi").select("text")
    sets = again.mapInArrow(tidy(_whole_sets), "d1 bigint, d2 bigint, tokens binary")
    sets = stage(sets.join(_few(some, n_some), ["d1", "d2"]).select("cls", "n", "tokens"), "sets")
    if sets.count() > n_some:  # rows that share their id with another row
        sets = stage(sets.dropDuplicates(["cls"]), "sets")

    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = _partitions(spark, total, limits.bucket)
    by_token = sets.mapInArrow(_deal(parts, shared), PACKED).groupBy("part").applyInArrow(_shared(parts), PACKED)
    by_owner = by_token.unionAll(sets.mapInArrow(_hot_of(parts, shared), PACKED)).groupBy("part")
    ordered = by_owner.applyInArrow(_ordered, "cls bigint, m bigint, tokens binary, held binary")
    kept = ordered.join(_few(some.select("cls", "n"), n_some), "cls").filter(F.col("m") * OF >= F.col("n") * NEED)
    most = F.expr(f"(m * {OF + NEED}) div {NEED} - n").alias("most")
    kept = stage(kept.select("cls", "n", most, "tokens", "held"), "kept")

    index = stage(kept.mapInArrow(_prefix_index(limits), INDEX), "index")
    places = _partitions(spark, index.count(), 1 << 19)
    part = F.pmod(F.xxhash64("sig", "salt"), F.lit(places)).alias("part")
    found = index.select("*", part).groupBy("part").applyInArrow(_pairs(limits.few), "kind int, a bigint, b bigint")
    found = stage(found, "candidates")
    pairs = found.filter("kind = 0").select("a", "b").distinct()
    mine = kept.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    theirs = kept.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    links = stage(pairs.join(theirs, "b").join(mine, "a").mapInArrow(tidy(_verify), "a bigint, b bigint"), "links")

    labels = components(links)
    members = found.filter("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("cls")).distinct()
    more = _rest(members, labels, kept, limits.compared)
    if more is not None:
        labels = components(stage(links.unionAll(more), "links"))
    named = some.join(labels, F.col("cls") == F.col("node"))
    least = named.groupBy("label").agg(F.min("rep").alias("component"))
    return rows, stage(named.join(least, "label").select("d1", "d2", "component"), "linked")


def _components(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """For every class of rows with words (_d1, _d2) its component's smallest id, and
    whether the class is large: of its rows, one in HOT_CLASSES is."""
    classes = rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("docs"))
    # of copies without links the class is their own smallest id
    joined = classes.join(linked, ["d1", "d2"], "left").select(
        F.col("d1").alias("_d1"),
        F.col("d2").alias("_d2"),
        F.coalesce("component", "rep").alias("component"),
        (F.col("docs") * HOT_CLASSES > rows.count()).alias("large"),
    )
    return stage(joined, "classes")


def _classified(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows with their class; those of large classes, of which there are few, don't move."""
    mine = (F.col("n") > 0) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    large = F.broadcast(of.filter("large"))
    rest = rows.join(large, mine, "left_anti").join(of.filter("not large"), mine, "left")
    return rest.unionByName(rows.join(large, mine))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = DEFAULT) -> DataFrame:
    """For each document: doc_id, n_shingles, component_id."""
    rows, linked = linked_classes(docs, doc_id, text, limits)
    joined = _classified(rows, _components(rows, linked))
    return joined.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole rows with the digest of their set."""
    for batch in batches:
        sets = [s for _, part in _sets(batch, "text") for s in part]
        pairs = [_digest(s) for s in sets]
        new = [[len(s) for s in sets], [a for a, _ in pairs], [b for _, b in pairs]]
        columns = [batch.column("row"), *[pa.array(c, pa.int64()) for c in new]]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "d1", "d2"])


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, that of the smallest id; documents without words stay.

    Rows that repeat an id and a text are one document; different texts under one id are
    two. A row with a null id goes if its class has a document with an id; of classes that
    have none, one row of each set of shingles stays. All columns stay as they are: a row
    travels as one struct, so no name is in the way."""
    rows, linked = linked_classes(docs, doc_id, text)
    of = _components(rows, linked)
    own = F.when(F.col("n") > 0, F.col("component") == F.col("id")).otherwise(True)
    found = _classified(rows, of).filter("id is not null").groupBy(F.col("id").alias("_kept"))
    # ids of which no text stays; far fewer than those that stay
    found = stage(found.agg(F.max(own).alias("_own"), F.count("*").alias("_rows")), "kept-ids")
    gone = found.filter("not _own").select("_kept")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    held = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    same = F.col("id") == F.col("_kept")
    out = held.filter("id is not null").join(gone, same, "left_anti")
    again = found.filter("_own and _rows > 1").select("_kept")
    if again.limit(1).count():
        once = out.join(again, same, "left_semi").withColumn("same", F.xxhash64("text")).dropDuplicates(["id", "same"])
        out = out.join(again, same, "left_anti").unionByName(once.drop("same"))
    out = out.select("row")
    if rows.filter("id is null").limit(1).count():
        unnamed = held.filter("id is null").select("row", "text")
        schema = T.StructType([unnamed.schema["row"], *[T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")]])
        mine = (F.col("n") > 0) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
        alone = unnamed.mapInArrow(tidy(_named), schema).join(of, mine, "left").filter("component is null")
        one = alone.filter("n > 0").dropDuplicates(["d1", "d2"]).unionByName(alone.filter("n = 0"))
        out = out.unionByName(one.select("row"))
    return out.select("row.*")
