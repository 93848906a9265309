"""Problem 8: fill containers of fixed capacity with documents measured in tokens.

First-fit decreasing with a tournament tree over the bins' free room, run independently in randomised groups of
documents. The group of a document is a hash of its id and a seed, with the number of groups proportional to the
number of documents, so a group stays near ``group_size`` rows whatever the data's sources or sizes; only ids and
token counts are shuffled, never texts.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layoutgraph.plans.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MAX_RANK_FILE = 50_000_000
TASK_GROUPS = 50  # groups of a task in a large table
#: Fixed value: the published split pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, object] = {}


def encoder(path: str, data: bytes | None = None):
    """The encoder of a .tiktoken rank file, loaded once per worker; ``data`` is the file's content where it isn't at hand."""
    if path not in _encoders:
        import base64

        import tiktoken

        if data is None:
            with open(path, "rb") as f:
                data = f.read()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens); a null or empty text has 0 tokens. The driver reads the rank file and sends it to the executors,
    which need no copy of their own; a file above MAX_RANK_FILE bytes is refused."""
    if os.path.getsize(path) > MAX_RANK_FILE:
        raise ValueError(f"{path} is larger than {MAX_RANK_FILE} bytes")
    with open(path, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def count(batches):
        enc = encoder(path, shared.value)
        for pdf in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in pdf.text]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "n_tokens": pd.Series(sizes, dtype="int64")})

    return documents.select("doc_id", "text").mapInPandas(count, "doc_id long, n_tokens long")


class RoomTree:
    """Tournament tree: each inner node holds the larger free room of its two children."""

    def __init__(self, leaves: int):
        self.width = 1
        while self.width < max(1, leaves):
            self.width *= 2
        self.room = [0] * (2 * self.width)

    def set(self, leaf: int, room: int) -> None:
        k = leaf + self.width
        self.room[k] = room
        while k > 1:
            k //= 2
            self.room[k] = max(self.room[2 * k], self.room[2 * k + 1])

    def first_with(self, need: int) -> int:
        """The leftmost leaf with at least ``need`` room, or -1."""
        if self.room[1] < need:
            return -1
        k = 1
        while k < self.width:
            k = 2 * k if self.room[2 * k] >= need else 2 * k + 1
        return k - self.width


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """(bin of each item, number of bins). Every size must be at most ``capacity``; equal sizes keep their order."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    tree, where, used = RoomTree(len(sizes)), [0] * len(sizes), 0
    for leaf in range(len(sizes)):
        tree.room[leaf + tree.width] = capacity
    for k in range(tree.width - 1, 0, -1):
        tree.room[k] = max(tree.room[2 * k], tree.room[2 * k + 1])
    for i in order:
        leaf = tree.first_with(sizes[i])
        where[i] = leaf
        tree.set(leaf, tree.room[leaf + tree.width] - sizes[i])
        used = max(used, leaf + 1)
    return where, used


def pack(sizes: DataFrame, containers: DataFrame, group_size: int = 4000, seed: int = 0) -> DataFrame:
    """Place every item of ``sizes`` (doc_id, n_tokens) in containers of each kind.

    Result: container_kind, container_id, doc_id, part, token_start, token_end (end exclusive). An item larger than
    the capacity is cut into full containers and one remainder, which is packed like any other item; no other item is
    split. Items of no tokens take a place with token_start = token_end = 0. Repeated rows are packed each; a null
    doc_id is packed too. A null or non-positive capacity, or a null container_kind, takes no items. Token counts are
    written once, so texts are tokenised once; ``containers`` is a list of kinds, all of which are packed.
    """
    sizes = cut(sizes.select("doc_id", "n_tokens"), "sizes")
    kinds = [(r["container_kind"], int(r["capacity_tokens"])) for r in containers.filter("container_kind is not null and capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().orderBy("container_kind", "capacity_tokens").collect()]
    groups = max(1, -(-sizes.count() // group_size))
    keyed = sizes.select("doc_id", "n_tokens", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed)), F.lit(groups)).alias("grp"))

    def place(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "n_tokens"], kind="stable")
        ids, tokens = pdf.doc_id.tolist(), pdf.n_tokens.tolist()
        out = []
        for kind, capacity in kinds:
            pieces, full = [], 0
            for doc, n in zip(ids, tokens):
                start, part = 0, 0
                while n - start > capacity:
                    out.append((kind, f"{key[0]}-f{full}", doc, part, start, start + capacity))
                    start, part, full = start + capacity, part + 1, full + 1
                pieces.append((doc, part, start, n))
            where, _ = first_fit_decreasing([n - s for _, _, s, n in pieces], capacity)
            out += [(kind, f"{key[0]}-{b}", doc, part, s, n) for (doc, part, s, n), b in zip(pieces, where)]
        return pd.DataFrame(out, columns=["container_kind", "container_id", "doc_id", "part", "token_start", "token_end"])

    # a number given keeps small groups, which are long work, from being put into one task
    tasks = min(groups, max(4 * keyed.sparkSession.sparkContext.defaultParallelism, groups // TASK_GROUPS))
    return keyed.repartition(tasks, "grp").groupBy("grp").applyInPandas(place, "container_kind string, container_id string, doc_id long, part long, token_start long, token_end long")


def fill_report(placed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: containers used, tokens placed, share of the room that is filled."""
    used = placed.groupBy("container_kind").agg(F.countDistinct("container_id").alias("containers"), F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    room = F.col("containers") * F.col("capacity_tokens")
    return used.join(containers.select("container_kind", "capacity_tokens").distinct(), "container_kind").select("container_kind", "capacity_tokens", "containers", "tokens", F.round(F.col("tokens") / room, 4).alias("filled"))
