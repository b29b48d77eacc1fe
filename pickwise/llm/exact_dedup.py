"""Exact dedup with Patricia-trie owners.

Equal texts meet in the partition of their byte length and content hash.  There a
compressed radix trie takes whole byte strings; a terminal node holds the row that
stays and the number of rows.  Tries run twice: over each input partition first, so
that a text sends one row per input task however often it occurs, and then in the
partitions that own the texts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import slices, spread, written

#: bytes of text that one input task's trie holds before it hands its largest subtree on
TRIE_BYTES = 8 << 20


class Node:
    """An edge label, the children by first byte, and what a string ending here stores."""

    __slots__ = ("edge", "kids", "terminal")

    def __init__(self, edge: bytes):
        self.edge, self.kids, self.terminal = edge, {}, None


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Compressed trie over byte strings; ``size`` is the bytes on its edges, ``weight`` by first byte."""

    def __init__(self):
        self.root, self.size, self.weight = Node(b""), 0, {}

    def terminal(self, key: bytes) -> Node:
        """The node where ``key`` ends, made if need be."""
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Node(key[at:])
                self.size += len(kid.edge)
                self.weight[key[0]] = self.weight.get(key[0], 0) + len(kid.edge)
                return kid
            if key.startswith(kid.edge, at):
                node, at = kid, at + len(kid.edge)
                continue
            n = common_prefix(kid.edge, key, at)
            middle = Node(kid.edge[:n])
            kid.edge = kid.edge[n:]
            middle.kids[kid.edge[0]] = kid
            node.kids[middle.edge[0]] = middle
            node, at = middle, at + n
        return node

    def pop(self, first: int | None = None) -> Iterator[tuple[bytes, object]]:
        """Take out the subtree under a first byte (None: the whole trie): (string, stored) pairs."""
        kids = self.root.kids
        stack = []
        for k in [first] if first is not None else list(kids):
            stack.append((b"", kids.pop(k)))
            self.size -= self.weight.pop(k)
        while stack:
            prefix, node = stack.pop()
            key = prefix + node.edge
            if node.terminal is not None:
                yield key, node.terminal
            stack += [(key, kid) for kid in node.kids.values()]

    def largest(self) -> int:
        """First byte of the heaviest subtree."""
        return max(self.weight, key=self.weight.get)


HEAD = ">Qq"  # content hash and length lead every key: subtrees are dealt by them

LOCAL = ("doc_id long, seq long, rep long, text_sha256 string, "
         "n int, h long, text binary, rows long, best_id long, best_seq long")


def better(keep: str):
    """Whether (id, seq) a stays rather than b; no id loses, the earlier row wins a tie."""
    sign = 1 if keep == "largest" else -1

    def wins(a, b):
        if a[0] is None or b[0] is None:
            return (b[0] is None, -a[1]) > (a[0] is None, -b[1])
        return (sign * a[0], -a[1]) > (sign * b[0], -b[1])
    return wins


def local_tries(keep: str, trie_bytes: int):
    wins = better(keep)

    def run(batches):
        base = TaskContext.get().partitionId() << 36
        trie, seq = RadixTrie(), base
        schema = None

        def owners(pairs):
            """A row for every text that leaves the trie."""
            rows = []
            size = 0
            for key, (rep, best, count) in pairs:
                h, n = struct.unpack_from(HEAD, key)
                rows.append((None, None, rep, None, n, h - (1 << 63), key[16:], count, *best))
                size += len(key)
                if size > 8 << 20:
                    yield table(rows)
                    rows, size = [], 0
            if rows:
                yield table(rows)

        def table(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        schema = pa.schema([("doc_id", pa.int64()), ("seq", pa.int64()), ("rep", pa.int64()),
                            ("text_sha256", pa.string()), ("n", pa.int32()), ("h", pa.int64()),
                            ("text", pa.binary()), ("rows", pa.int64()), ("best_id", pa.int64()),
                            ("best_seq", pa.int64())])
        for batch in slices(batches):
            ids, sha, n, h, text = (batch.column(i) for i in range(5))
            members = []
            for i in range(batch.num_rows):
                doc = ids[i].as_py()
                data = text[i].as_py()
                key = struct.pack(HEAD, h[i].as_py() + (1 << 63), n[i].as_py()) + data
                node = trie.terminal(key)
                if node.terminal is None:
                    node.terminal = (seq, (doc, seq), 1)
                else:
                    rep, best, count = node.terminal
                    node.terminal = (rep, (doc, seq) if wins((doc, seq), best) else best, count + 1)
                members.append((doc, seq, node.terminal[0], sha[i].as_py(), None, None, None, None, None, None))
                seq += 1
                if trie.size > trie_bytes:
                    yield from owners(trie.pop(trie.largest()))
            if members:
                yield table(members)
        yield from owners(trie.pop())
    return run


def owner_tries(keep: str):
    """Over rows sorted by (h, n): a subtree leaves the trie once its last row has passed."""
    wins = better(keep)

    def run(batches):
        trie, last = RadixTrie(), None

        def settled():
            rep, keep_id, keep_seq, size = [], [], [], []
            for _, (reps, best, count) in trie.pop():
                rep += reps
                keep_id += [best[0]] * len(reps)
                keep_seq += [best[1]] * len(reps)
                size += [count] * len(reps)
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (rep, keep_id, keep_seq, size)],
                names=["rep", "keep_id", "keep_seq", "group_size"])

        for batch in slices(batches):
            rep, n, h, text, rows, best_id, best_seq = (batch.column(i) for i in range(7))
            for i in range(batch.num_rows):
                head = (h[i].as_py(), n[i].as_py())
                if head != last and trie.size > 1 << 20:  # the subtrees of earlier heads are whole
                    yield settled()
                last = head
                node = trie.terminal(struct.pack(HEAD, head[0] + (1 << 63), head[1]) + text[i].as_py())
                best = (best_id[i].as_py(), best_seq[i].as_py())
                if node.terminal is None:
                    node.terminal = ([rep[i].as_py()], best, rows[i].as_py())
                else:
                    reps, old, count = node.terminal
                    reps.append(rep[i].as_py())
                    node.terminal = (reps, best if wins(best, old) else old, count + rows[i].as_py())
        if trie.root.kids:
            yield settled()
    return run


def exact_dedup(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty.  The
    row with the largest (or ``keep="smallest"``) doc_id of equal texts stays.
    A row without doc_id stays only if no row of its group has one (keep_id is then
    null).  Of rows that repeat id and text exactly one is kept.  An empty table
    gives an empty result; other columns are ignored.

    Bounds: an input task holds ``trie_bytes`` of text and a batch; an owner holds the
    strings of one length and hash, which reach it once per input task (or eviction),
    plus 1 MB; Spark's sort spills the rest.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.sha2(text, 256).alias("text_sha256"),
                       F.octet_length(text).alias("n"), F.xxhash64(text).alias("h"),
                       text.cast("binary").alias("text"))
    local = written(rows.mapInArrow(local_tries(keep, trie_bytes), LOCAL))
    owners = (spread(local.filter(F.col("text").isNotNull())
                     .select("rep", "n", "h", "text", "rows", "best_id", "best_seq"), "n", "h")
              .sortWithinPartitions("h", "n")
              .mapInArrow(owner_tries(keep), "rep long, keep_id long, keep_seq long, group_size long"))
    members = local.filter(F.col("seq").isNotNull()).select("doc_id", "seq", "rep", "text_sha256")
    return (members.join(owners, "rep")
            .select("doc_id", "keep_id", "group_size", (F.col("seq") == F.col("keep_seq")).alias("kept"),
                    "text_sha256"))
