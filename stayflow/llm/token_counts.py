"""Token counts that follow edits: a segment tree of pre-token runs for each document."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.bpe import parse_ranks, read_ranks
from stayflow.llm.word_memory import space_chunks

#: Characters of a leaf, at least, except for the last one.
LEAF = 256


def runs(text: str) -> list[str]:
    """The text in pieces of about ``LEAF`` characters, cut where pre-tokens end whatever stands
    before: before a space that a non-space follows."""
    out, held, size = [], [], 0
    for chunk in space_chunks(text):
        held.append(chunk)
        size += len(chunk)
        if size >= LEAF:
            out.append("".join(held))
            held, size = [], 0
    return [*out, "".join(held)] if held else out


class TokenTree:
    """Runs of a text as leaves; every node has the characters and tokens under it."""

    def __init__(self, leaves: list[str], tokens: list[int], count: Callable[[str], int]):
        self.count = count
        #: Characters that were encoded by edits.
        self.encoded = 0
        self._fill(leaves, tokens)

    @classmethod
    def of(cls, text: str, count: Callable[[str], int]) -> TokenTree:
        leaves = runs(text)
        return cls(leaves, [count(x) for x in leaves], count)

    def _fill(self, leaves: list[str], tokens: list[int]) -> None:
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.leaves = leaves + [""] * (self.width - len(leaves))
        self.chars = [0] * self.width + [len(x) for x in self.leaves]
        self.tokens = [0] * self.width + tokens + [0] * (self.width - len(tokens))
        for node in range(self.width - 1, 0, -1):
            self._add(node)

    def _add(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1] if self.width > 1 else len(self.leaves[0])

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def find(self, offset: int) -> tuple[int, int]:
        """The leaf with the character at ``offset`` (under ``n_chars``), and its place in it."""
        node = 1
        while node < self.width:
            node *= 2
            if offset >= self.chars[node]:
                offset -= self.chars[node]
                node += 1
        return node - self.width, offset

    def set(self, leaf: int, text: str, tokens: int) -> None:
        node = leaf + self.width
        self.leaves[leaf], self.chars[node], self.tokens[node] = text, len(text), tokens
        while node > 1:
            node //= 2
            self._add(node)

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``start`` on; both are cut to the text.

        Encoded anew are the leaves the edit touches, and the one before if the edit reaches the
        space or the character after it that begin the first of them: only these two keep the
        pre-tokens on both sides apart.
        """
        n = self.n_chars
        start = min(max(start, 0), n)
        removed = min(max(removed, 0), n - start)
        if not n:
            first = last = at = 0
        else:
            first, at = self.find(start if start < n else n - 1)
            at += start == n
            last = self.find(start + removed - 1)[0] if removed else first
            while at < 2 and first > 0:
                first -= 1
                at += len(self.leaves[first])
            # What begins the leaf after must be as it was: it is, since it is not touched.
        old = "".join(self.leaves[first : last + 1])
        new = runs(old[:at] + inserted + old[at + removed :])
        tokens = [self.count(x) for x in new]
        self.encoded += sum(map(len, new))
        slots = last + 1 - first
        if len(new) > slots:
            kept = self.tokens[self.width :]
            leaves = [(x, t) for x, t in zip(self.leaves, kept)]
            leaves[first : last + 1] = list(zip(new, tokens))
            leaves = [(x, t) for x, t in leaves if x]
            self._fill([x for x, _ in leaves], [t for _, t in leaves])
            return
        for i in range(slots):
            self.set(first + i, new[i] if i < len(new) else "", tokens[i] if i < len(new) else 0)


@lru_cache(maxsize=2)
def counter_of(content: bytes, pattern: str) -> Callable[[str], int]:
    encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=parse_ranks(content), special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def recount(
    docs: DataFrame, edits: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token counts before and after edits, encoding again only what the edits touch.

    ``edits`` has (doc_id, seq, start, removed, inserted): from character ``start`` on, ``removed``
    characters give way to the text ``inserted``; a document's edits come in order of ``seq`` and refer
    to the text as the ones before left it. Returns a row for each row of ``docs``: doc_id, n_chars,
    n_tokens, edits, edited_chars, edited_tokens, encoded_chars (characters encoded because of edits),
    edited_text, and the tree of the edited text as leaf_chars and leaf_tokens, from which later edits
    can go on.

    NULL texts are empty; places beyond the text are moved to its end, negative ones to its start; a
    NULL start, removed or inserted is 0, 0 or empty. Edits of an id that no document has, or of a
    NULL id, apply to nothing; rows that repeat an id are edited each. The edits of one document are
    collected for it; documents are not collected. ``pattern`` must end its matches before a space
    that a non-space follows, as the public pattern does.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    change = F.struct(
        F.col("seq"), F.coalesce(F.col("start"), F.lit(0)).cast("long").alias("start"),
        F.coalesce(F.col("removed"), F.lit(0)).cast("long").alias("removed"),
        F.coalesce(F.col("inserted"), F.lit("")).alias("inserted"),
    )
    by_id = edits.groupBy(F.col("doc_id").alias("of")).agg(F.array_sort(F.collect_list(change)).alias("changes"))
    joined = rows.join(by_id, rows["doc_id"] == by_id["of"], "left").select("doc_id", "text", "changes")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter_of(content.value, pattern)
        for pdf in batches:
            out = []
            for doc_id, text, changes in zip(pdf["doc_id"], pdf["text"], pdf["changes"]):
                tree = TokenTree.of(text or "", count)
                before = (tree.n_chars, tree.n_tokens)
                changes = [] if changes is None else changes
                for c in changes:
                    tree.edit(c["start"], c["removed"], c["inserted"])
                leaves = [i for i, x in enumerate(tree.leaves) if x]
                out.append(
                    (doc_id, *before, len(changes), tree.n_chars, tree.n_tokens, tree.encoded, tree.text,
                     [len(tree.leaves[i]) for i in leaves], [tree.tokens[tree.width + i] for i in leaves])
                )
            frame = pd.DataFrame(out, columns=names)
            if kind == "bigint":
                frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    names = ["doc_id", "n_chars", "n_tokens", "edits", "edited_chars", "edited_tokens", "encoded_chars", "edited_text",
             "leaf_chars", "leaf_tokens"]
    return joined.mapInPandas(
        counted,
        f"doc_id {kind}, n_chars long, n_tokens long, edits long, edited_chars long, edited_tokens long, "
        "encoded_chars long, edited_text string, leaf_chars array<int>, leaf_tokens array<int>",
    )
