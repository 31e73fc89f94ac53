"""Edit-aware token counts: segment trees over pre-token segments.

A text is cut where a space stands between two letters, at which the byte-level
BPE pre-tokeniser always starts a token; so a text's tokens are those of its
segments, one after the other.  A document's tree holds the segments' token
counts and their subtree sums.  An edit touches a range of segments: that
range is widened until its borders are cuts that the edit leaves alone, its new text
is encoded anew, and the sums above the changed leaves are updated.  All other
segments keep their counts, and the total equals encoding the edited text afresh.

Edge cases: null and empty texts have 0 tokens and no segments; edits are
(start, end, replacement) in code points, sorted and disjoint, and insertions are
empty ranges; a text without cuts is one segment.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from linkrec.llm.common import small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEGMENT_CHARS = 512
#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def load_encoder(path: str = VOCABULARY):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cuts(text: str, chars: int = SEGMENT_CHARS) -> list[int]:
    """Segment starts: the first safe place at least `chars` after the last one."""
    out, at = [0] if text else [], chars
    while at < len(text):
        m = _CUT.search(text, max(at - 1, 1))
        if m is None:
            break
        out.append(m.start())
        at = m.start() + chars
    return out


def build(leaves: list[int]) -> list[int]:
    """Sums of a perfect binary tree, root at 1, leaves from len / 2 on."""
    n = 1
    while n < len(leaves):
        n *= 2
    tree = [0] * n + leaves + [0] * (n - len(leaves))
    for i in range(n - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def update(tree: list[int], leaf: int, value: int) -> None:
    i = len(tree) // 2 + leaf
    change = value - tree[i]
    while i and change:
        tree[i] += change
        i //= 2


class CountedText:
    """A text with its segment starts and the tree of token counts."""

    def __init__(self, text: str | None, count: Callable[[list[str]], list[int]]):
        self.text, self.count = text or "", count
        self.starts = cuts(self.text)
        ends = [*self.starts[1:], len(self.text)]
        self.tree = build(count([self.text[a:b] for a, b in zip(self.starts, ends)]))

    @property
    def tokens(self) -> int:
        return self.tree[1] if len(self.tree) > 1 else 0

    def _regions(self, edits) -> list[tuple[int, int, list]]:
        """(first segment, last segment, edits) of the parts to encode anew, disjoint."""
        out: list = []
        last = len(self.starts) - 1
        for e in edits:
            start, end = e[0], e[1]
            i = max(0, bisect_right(self.starts, start) - 1)
            # the cut before segment i stands if its space and the letters around it stay
            while i > 0 and start <= self.starts[i] + 1:
                i -= 1
            j = max(i, bisect_left(self.starts, end) - 1)
            while j < last and end >= self.starts[j + 1]:
                j += 1
            if out and i <= out[-1][1]:
                out[-1] = (min(out[-1][0], i), max(out[-1][1], j), out[-1][2] + [e])
            else:
                out.append((i, j, [e]))
        return out

    def edit(self, edits) -> tuple[int, int]:
        """Applies the edits: the token count after them, and how many characters were encoded for it.
        Text, segments and tree are those of the edited text then, so further edits may follow."""
        edits = sorted(edits)
        if not edits:
            return self.tokens, 0
        if not self.starts:
            self.__init__("".join(r for _, _, r in edits), self.count)
            return self.tokens, len(self.text)
        regions, texts = self._regions(edits), []
        for i, j, own in regions:
            at, end, parts = self.starts[i], self.starts[j + 1] if j + 1 < len(self.starts) else len(self.text), []
            for s, e, new in own:
                parts += [self.text[at:s], new]
                at = e
            texts.append("".join([*parts, self.text[at:end]]))
        self._replace(regions, texts)
        return self.tokens, sum(map(len, texts))

    def _replace(self, regions, texts: list[str]) -> None:
        """Puts the new texts in the regions' places; only these are cut and encoded."""
        inner = [cuts(t) for t in texts]
        counts = iter(self.count([t[x:y] for t, own in zip(texts, inner) for x, y in zip(own, [*own[1:], len(t)])]))
        size = len(self.tree) // 2
        fits = all(j - i + 1 == len(own) for (i, j, _), own in zip(regions, inner))
        starts, leaves, parts, at, seg = [], [], [], 0, 0

        def keep(to: int) -> None:
            """The segments seg .. to - 1 stay, moved to where the new text has come to."""
            nonlocal at, seg
            if seg < to:
                first, end = self.starts[seg], self.starts[to] if to < len(self.starts) else len(self.text)
                starts.extend(x - first + at for x in self.starts[seg:to])
                leaves.extend(self.tree[size + seg:size + to])
                parts.append(self.text[first:end])
                at, seg = at + end - first, to

        for (i, j, _), text, own in zip(regions, texts, inner):
            keep(i)
            new = [next(counts) for _ in own]
            starts.extend(x + at for x in own)
            leaves.extend(new)
            parts.append(text)
            at, seg = at + len(text), j + 1
            if fits:
                for k, n in enumerate(new):
                    update(self.tree, i + k, n)
        keep(len(self.starts))
        self.text, self.starts = "".join(parts), starts
        if not fits:
            # another number of leaves: the sums are added up again, nothing more is encoded
            self.tree = build(leaves)


_REDACT = re.compile(r"[0-9][0-9 .()-]{6,}[0-9]|[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9.-]{3,255}")


def redactions(text: str | None) -> list[tuple[int, int, str]]:
    """The edits of the registered query: long numbers and mail addresses give way to a mark."""
    return [(m.start(), m.end(), "[redacted]") for m in _REDACT.finditer(text or "")]


def token_counts(docs: DataFrame, edits: Callable[[str | None], list] = redactions,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, n_segments, n_edits, n_tokens_edited, n_chars_encoded) of every document: its
    tokens, and its tokens after `edits(text)`, for which n_chars_encoded characters were encoded again."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load_encoder(vocabulary)

        def count(parts: list[str]) -> list[int]:
            return [len(encoder.encode_ordinary(p)) for p in parts]
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["doc_id"], pdf["text"]):
                doc = CountedText(text, count)
                n, todo = doc.tokens, edits(text)
                after, encoded = doc.edit(todo)
                rows.append((i, n, len(doc.starts), len(todo), after, encoded))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "n_segments", "n_edits", "n_tokens_edited",
                                              "n_chars_encoded"]).astype({"doc_id": "Int64"})
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        run, "doc_id long, n_tokens long, n_segments long, n_edits long, n_tokens_edited long, n_chars_encoded long")
