"""Byte-pair encoding of words over a trie of their prefixes, and decoding.

The encoding of a word is found from those of its prefixes. For each prefix only its last
token matters: the last token of a longer prefix is the one token that ends there and whose
left neighbour, the last token of what stands before it, could stand there next to it, i.e.
encoding the two tokens' text together gives just these two. Following last tokens back from
a word's end gives its tokens. Words that begin alike share these states, so the distinct
words of a batch are put into a trie and each of its nodes is worked out once, depth first.

Texts are handled where they are read: nothing is shuffled. A task keeps the encodings it has
found, with their text, for the next batch, in two generations of bounded size; results never
depend on what is kept.

Defined cases: a null text is an empty one: no tokens, empty decoded text. Special strings of
the vocabulary inside a text are single tokens. Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from pagetide.llm.common import text_of
from pagetide.llm.packing import byte_symbols

#: Control characters that str.split takes for white space and Unicode does not.
CONTROLS = re.compile("[\x1c-\x1f]")
SPACES = regex.compile(r"\s+")


class Vocabulary:
    """A word-level BPE vocabulary: tokens, merges, word ends, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in chain(self.ids.items(), self.special.items())}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            joined = a.removesuffix(self.end) + b if self.end else a + b
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[joined]))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.byte = {b: c for c, b in byte_symbols().items()}

    def shown(self, word: str) -> str:
        """The word's bytes as symbols, one character each; the last is yet to be marked as the word's end."""
        return word if word.isascii() and word.isprintable() else "".join([self.byte[b] for b in word.encode()])

    def merged(self, ids: list[int]) -> list[int]:
        """Plain merging, lowest rank first, of a short list of tokens."""
        ids = list(ids)
        while len(ids) > 1:
            best = min(
                ((m[0], i, m[1]) for i in range(len(ids) - 1) if (m := self.merges.get((ids[i], ids[i + 1])))),
                default=None,
            )
            if best is None:
                break
            ids[best[1] : best[1] + 2] = [best[2]]
        return ids

    def parts(self, token: int) -> list[int]:
        """The single symbols of a token."""
        text = self.tokens[token]
        if self.end and text.endswith(self.end) and len(text) > len(self.end):
            stem = text.removesuffix(self.end)
            shown = [*stem[:-1], stem[-1] + self.end]
        else:
            shown = list(text)
        return [self.ids[s] for s in shown]


NEVER = 1 << 62


class Trie:
    """Encodes words; see the module's description.

    The trie of the words is walked depth first by taking the words in order: what a word
    shares with the one before it is the path that both have in the trie, and its states stay.
    """

    def __init__(self, vocabulary: Vocabulary, keep: int = 300_000):
        self.v, self.keep = vocabulary, keep
        self.together: dict[int, bool] = {}
        # How a token comes about: its two parts, the rank of the merge; None if its text is
        # not encoded as the token.
        self.made: dict[int, tuple[int, int, int] | None] = {}
        self.plain: dict[int, bool] = {}
        # The tokens as a trie of their symbols; "" holds the token that ends at a node.
        self.tokens: dict = {}
        for token in vocabulary.ids.values():
            node = self.tokens
            for part in vocabulary.parts(token):
                node = node.setdefault(vocabulary.tokens[part], {})
            node[""] = token

    def made_of(self, token: int) -> tuple[int, int, int] | None:
        if token not in self.made:
            ids, last = self.v.parts(token), (-1, -1, -1)
            while len(ids) > 1:
                best = min(
                    ((m[0], i, m[1]) for i in range(len(ids) - 1) if (m := self.v.merges.get((ids[i], ids[i + 1])))),
                    default=None,
                )
                if best is None:
                    break
                rank, i, joined = best
                last = (ids[i], ids[i + 1], rank)
                ids[i : i + 2] = [joined]
            self.made[token] = last if ids == [token] else None
        return self.made[token]

    def ordered(self, token: int) -> bool:
        """Whether each merge of the token has a higher rank than those of its parts."""
        known = self.plain.get(token)
        if known is None:
            left, right, rank = self.made_of(token)
            known = left < 0 or all(
                self.made_of(p) is not None and self.made_of(p)[2] < rank and self.ordered(p) for p in (left, right)
            )
            self.plain[token] = known
        return known

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """What stands at a token's end while it is merged, from its symbol on, and the rank that ends it."""
        out, after = [], NEVER
        while True:
            out.append((token, after))
            made = self.made_of(token)
            if made[0] < 0:
                return out[::-1]
            token, after = made[1 if right else 0], made[2]

    def may_meet(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are where they stand next to each other.

        They do unless the pair at the boundary is merged before one of it is merged away. Of
        merges of one rank the leftmost comes first.
        """
        pair = left << 32 | right
        known = self.together.get(pair)
        if known is None:
            if len(self.together) > self.keep:
                self.together.clear()
            known = self.together[pair] = self._may_meet(left, right)
        return known

    def _may_meet(self, left: int, right: int) -> bool:
        if self.made_of(left) is None or self.made_of(right) is None:
            return False
        if not (self.ordered(left) and self.ordered(right)):
            return self.v.merged(self.v.parts(left) + self.v.parts(right)) == [left, right]
        before, after, merges = self.edge(left, True), self.edge(right, False), self.v.merges
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = before[i], after[j]
            met = merges.get((x, y))
            if met is not None and met[0] < x_ends and met[0] <= y_ends:
                return False
            if x_ends == NEVER and y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def stays(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token."""
        return self.made_of(token) is not None

    def encode(self, words: set[str]) -> dict[str, list[int]]:
        """Encodings of the words, none of them empty."""
        out: dict[str, list[int]] = {}
        order = sorted((self.v.shown(w), w) for w in words)
        longest = max((len(s) for s, _ in order), default=0)
        # The states of the path: the last token, where it starts, and the starts from which a
        # token may still go on.
        last, begin = [0] * longest, [0] * longest
        going: list[list] = [[]] * (longest + 1)
        met, first, end = self.together, self.tokens, self.v.end
        path, known = "", 0
        for shown, word in order:
            top = len(shown) - 1
            shared = min(known, top)
            while not shown.startswith(path[:shared]):
                shared -= 1
            for depth in range(shared, top + 1):
                symbol = shown[depth] if depth < top else shown[depth] + end
                found, ongoing = -1, []
                # Of the tokens that end here, the longest that may follow what stands before it.
                for start, state in going[depth]:
                    below = state.get(symbol)
                    if below is None:
                        continue
                    ongoing.append((start, below))
                    if found < 0 and "" in below:
                        token = below[""]
                        if start:
                            left = last[start - 1]
                            fits = met.get(left << 32 | token)
                            if fits is None:
                                fits = self.may_meet(left, token)
                        else:
                            fits = self.stays(token)
                        if fits:
                            found = start
                            last[depth] = token
                alone = first[symbol]
                ongoing.append((depth, alone))
                if found < 0:
                    found = depth
                    last[depth] = alone[""]
                begin[depth] = found
                going[depth + 1] = ongoing
            ids, at = [], top
            while at >= 0:
                ids.append(last[at])
                at = begin[at] - 1
            out[word] = ids[::-1]
            path, known = shown, top  # the last symbol was marked as the word's end
        return out


class Kept(dict):
    """A cache in two generations: what was not used for a while goes, the rest stays."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def missing(self, keys: set) -> list:
        """The keys that neither generation has; the others are made young again."""
        new, old = [], self.old
        for key in keys - self.keys():
            found = old.get(key)
            if found is None:
                new.append(key)
            else:
                self[key] = found
        return new


class Encoder:
    """Texts to ids. Keeps what pieces between white space and words were encoded to."""

    def __init__(self, vocabulary: Vocabulary, keep: int = 100_000):
        self.v, self.trie = vocabulary, Trie(vocabulary)
        # Ids as 32-bit numbers one after the other, and their text.
        self.words, self.pieces = Kept(keep), Kept(keep)

    def split(self, text: str) -> list[str]:
        """Pieces between white space; no word and no special string crosses any."""
        return [p for p in SPACES.split(text) if p] if CONTROLS.search(text) else text.split()

    def _plain(self, piece: str) -> list[str]:
        """Words of a piece without special strings."""
        if piece.isascii():
            return self.v.words.findall(piece.lower())
        piece = unicodedata.normalize("NFC", piece)
        # Letter by letter: no letter's lower case depends on its neighbours.
        return self.v.words.findall("".join(c.lower() for c in piece))

    def _words(self, piece: str) -> list[str | int]:
        if "<" not in piece:
            return self._plain(piece)
        out: list[str | int] = []
        for part in self.v.specials.split(piece):
            out += [self.v.special[part]] if part in self.v.special else self._plain(part) if part else []
        return out

    def _kept(self, ids: list[int]) -> tuple[bytes, str]:
        return array("i", ids).tobytes(), " ".join([self.v.tokens[i] for i in ids])

    def batch(self, texts: list[str]) -> list[list[tuple[bytes, str]]]:
        """The ids of each text, as 32-bit numbers, and their text, piece by piece."""
        split = [self.split(t) for t in texts]
        self.pieces.turn()
        self.words.turn()
        new = {p: self._words(p) for p in self.pieces.missing(set(chain.from_iterable(split)))}
        unseen = {w for words in new.values() for w in words if isinstance(w, str)}
        for word, ids in self.trie.encode(set(self.words.missing(unseen))).items():
            self.words[word] = self._kept(ids)
        known = self.words
        for piece, words in new.items():
            parts = [known[w] if isinstance(w, str) else self._kept([w]) for w in words]
            self.pieces[piece] = parts[0] if len(parts) == 1 else (
                b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])
            )
        look = self.pieces.__getitem__
        return [list(map(look, pieces)) for pieces in split]


@lru_cache(maxsize=1)
def shared_encoder(tokenizer: str) -> Encoder:
    """One encoder per Python worker, for all tasks that it runs."""
    return Encoder(Vocabulary(tokenizer))


@lru_cache(maxsize=1)
def token_texts(tokenizer: str) -> dict[int, str]:
    """Tokens by id, one table per Python worker that decodes."""
    return Vocabulary(tokenizer).tokens


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    decode: bool = False,
    slice_rows: int = 512,
) -> DataFrame:
    """id, ids: array<int>, of every row; with ``decode`` also the text of the ids, ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):  # ids take more room than texts
                batch = whole.slice(at, slice_rows)
                found = encoder.batch(batch.column("text").to_pylist())
                ids = [b"".join([p[0] for p in pieces]) for pieces in found]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), np.int32)
                columns = [batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decode:
                    columns.append(pa.array([" ".join([p[1] for p in pieces if p[1]]) for pieces in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][: len(columns)])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>"
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, schema + ", decoded string" * decode)


def decoded(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of ``encoded`` with the text of its ``ids`` added as ``decoded``."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        look = token_texts(tokenizer).__getitem__
        for ids in batches:
            yield pd.Series([" ".join(map(look, i.tolist())) for i in ids], dtype=object)

    return encoded.withColumn("decoded", text("ids"))
