"""Token ids of whole texts from a public tokenizer file, one library call for many distinct words.

The word_bpe tokenizer never lets a token span ASCII white space: its normaliser works inside a run of letters, its
pre-tokeniser drops white space, and no added token holds any. A text's ids are therefore its white-space-separated
words' ids in order, and each distinct word needs the library once per worker. For a word in Latin-1 the library's BPE
model is called on the pieces directly, as normalising such text is lower-casing; any other word takes its full encode. Bytes that
aren't UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hintforge.llm.common import ragged_take

#: Distinct words, and their distinct pieces, that a worker remembers before it forgets all but the half most used.
CACHE_WORDS, CACHE_PIECES = 200_000, 200_000


#: For text in Latin-1, lower-cased: what the tokenizer file's own pattern yields there, and the line feed that divides words.
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\s0-9²³¹¼½¾a-zªµºß-öø-ÿ]+|\n")
#: Words with these go to the library whole: other alphabets, added tokens, separators that Python alone calls white space.
NOT_LATIN = re.compile("[^\x00-\x1b\x20-\xff]|<\\|")


def byte_letters() -> np.ndarray:
    """The public byte-level alphabet, as code points: printable Latin-1 characters stand for themselves, the others for 256 and up."""
    letters = np.arange(256, dtype="<u4")
    other = [b for b in range(256) if b not in {*range(33, 127), *range(161, 173), *range(174, 256)}]
    letters[other] = 256 + np.arange(len(other))
    return letters


class Remembered:
    """Lists of ids by text, under numbers in the order of first sight."""

    def __init__(self) -> None:
        self.known = defaultdict(count().__next__)
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)

    def numbers(self, items: list) -> tuple[np.ndarray, list]:
        """The items' numbers in one pass, and those not seen before, in the order of the numbers they got; their lists are to be added."""
        before = len(self.known)
        numbers = np.fromiter(map(self.known.__getitem__, items), np.int64, len(items))
        return numbers, [*islice(reversed(self.known), len(self.known) - before)][::-1]

    def add(self, flat: np.ndarray, lengths: np.ndarray, order: np.ndarray | None = None) -> None:
        """Lists that lie one after the other; order: which of the new numbers each gets, if not theirs in a row."""
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        if order is not None:
            back = np.argsort(order)
            starts, lengths = starts[back], lengths[back]
        self.starts, self.flat = np.concatenate([self.starts, starts]), np.concatenate([self.flat, flat])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.used = np.concatenate([self.used, np.zeros(len(lengths), np.int32)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbers' lists, one after the other, and sums of lengths with a 0 before."""
        self.used += np.bincount(numbers, minlength=len(self.used)).astype(np.int32)
        lengths = self.lengths[numbers].astype(np.int64)
        return ragged_take(self.flat, self.starts[numbers], lengths), np.concatenate([[0], np.cumsum(lengths)])

    def forget(self, most: int) -> None:
        """If there are more than `most`, all go but the half of that number most used, whose uses then count half."""
        if len(self.known) <= most:
            return
        keep = np.sort(np.argpartition(-self.used, most // 2)[: most // 2])
        items, old, used = [*self.known], self, self.used[keep] // 2
        items = [items[k] for k in keep.tolist()]
        flat, lengths = ragged_take(old.flat, old.starts[keep], old.lengths[keep].astype(np.int64)), old.lengths[keep]
        self.__init__()
        self.numbers(items)
        self.add(flat, lengths)
        self.used += used


class WordTokenizer:
    """ids(texts) gives all ids and each text's count; equal to the library's encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library, self.cache_words = Tokenizer.from_file(path), cache_words
        self.merger, self.letters = Tokenizer(self.library.model), byte_letters()
        self.letters[10] = 10  # no piece holds a line feed
        self.merger.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.last = np.zeros(self.library.get_vocab_size(), bool)
        self.last[[i for t, i in self.library.get_vocab().items() if t.endswith(self.library.model.end_of_word_suffix)]] = True
        self.words, self.pieces = Remembered(), Remembered()

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that the library's own BPE model gives for pieces in byte letters, and their numbers, in one call without offsets."""
        real = np.array([p != "\n" for p in pieces])
        raw = "\n".join([p for p in pieces if p != "\n"]).encode()
        spelt = self.letters[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-32-le")
        (made,) = self.merger.encode_batch_fast([spelt], add_special_tokens=False)
        ids, counts = np.array(made.ids, np.uint32), np.zeros(len(pieces), np.int64)
        counts[real] = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        return ids, counts

    def _learn(self, words: list[bytes]) -> None:
        """New words, in the order of their numbers: those in Latin-1 by their pieces, all in one pass; others by the library's full encode."""
        text, odd, order = b"\n".join(words).decode("utf-8", "replace"), [], None
        if NOT_LATIN.search(text):
            texts = text.split("\n")
            strange = [NOT_LATIN.search(t) is not None for t in texts]
            odd = [t for t, s in zip(texts, strange) if s]
            text = "\n".join(t for t, s in zip(texts, strange) if not s)
            order = np.argsort(strange, kind="stable")
        flat, lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(odd) < len(words):
            pieces = LATIN_PIECES.findall(text.lower())
            pieces.append("\n")
            numbers, new = self.pieces.numbers(pieces)
            if new:
                self.pieces.add(*self._merged(new))
            flat, sums = self.pieces.take(numbers)
            lengths = np.diff(sums[np.flatnonzero(numbers == self.pieces.known["\n"])], prepend=0)
        if odd:
            lists = [self.library.encode(t, add_special_tokens=False).ids for t in odd]
            flat = np.concatenate([flat, np.fromiter(chain.from_iterable(lists), np.uint32)])
            lengths = np.concatenate([lengths, np.fromiter(map(len, lists), np.int64, len(lists))])
        self.words.add(flat, lengths, order)

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        self.words.forget(self.cache_words)
        self.pieces.forget(CACHE_PIECES)
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))  # white space at an end leaves empty words, of no ids
        coded = split.flatten().dictionary_encode()
        numbers, new = self.words.numbers(coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        if new:
            self._learn(new)
        flat, sums = self.words.take(numbers[coded.indices.to_numpy()])
        counts = np.diff(split.offsets.to_numpy())
        ends = np.cumsum(counts)
        return flat, sums[ends] - sums[ends - counts]
