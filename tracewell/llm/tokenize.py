"""Exact batch tokenization with public vocabulary files.

Both vocabularies split a text by a pattern and then merge inside each piece, so the ids of a text are the ids of its
pieces one after another.  ``BatchTokenizer`` uses that: pieces go through a bounded piece-to-ids table that the
``tokenizers`` library fills, and numpy joins the ids.  Where no piece holds white space, Arrow
splits texts there, and of a block's words only the distinct ones are looked up, in a table of their own.  The shortcut is taken only for texts all of whose characters lie
in a range where normalisation and character classes are the same in every Unicode version; every other text, and every
very long piece, goes through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache, partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters whose classes, case and normal form are settled: printable ASCII, tab, LF, CR, U+00A1 to U+012F.
_UNSETTLED = re.compile("[^\t\n\r\x20-\x7e¡-į]")
_L = "A-Za-zªµºÀ-ÖØ-öø-į"
_N = "0-9²³¹¼-¾"
_S = "\t\n\r "
#: The vocabularies' own split patterns (fixed values of the files), with the classes written out for settled characters.
#: Words come first, as they are commonest and begin like no other piece.
_BYTE_PIECES = re.compile(f" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_WORD_PIECES = re.compile(f"[{_L}]+|[{_N}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_S}{_L}{_N}]+")


def vocabulary_path(name_or_path: str) -> str:
    """A file's path: as given if it is one, else the file of that name in the installed ``public_tokenizers``."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1 and so on, counts[0] numbers; then those from first[1] on, and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + counts, counts)


class IdTable:
    """Words and their ids, which learn gives one after another, with how many each word has. Of a full table, the words stay that were
    met again since keep was last called, half of it at most, the oldest first."""

    def __init__(self, size: int, longest: int, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.size, self.longest, self.learn = size, longest, learn
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 15, np.int64)
        self.count = np.zeros(1 << 15, np.int64)
        self.again = np.zeros(1 << 15, bool)
        self.used = 0

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, k = len(ids), len(self.at)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while k + len(words) > len(self.first):
            self.first, self.count, self.again = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.count, self.again))
        self.count[k : k + len(words)] = counts
        self.first[k : k + len(words)] = self.used + np.cumsum(counts) - counts
        self.flat[self.used : self.used + n] = ids
        self.used += n
        self.at.update(zip(words, range(k, k + len(words))))

    def keep(self, most: int) -> None:
        """Leaves the words that were met again since the last call, most of them at most, the oldest first. They are copied: a few old
        ones here and there would hold the memory of all."""
        kept = np.flatnonzero(self.again[: len(self.at)])[:most]
        words, counts, ids = list(self.at), self.count[kept], self.flat[spread(self.first[kept], self.count[kept])]
        copies = pa.array([words[k] for k in kept.tolist()], pa.string())
        del words
        self._clear()
        self._add(copies.to_pylist(), ids, counts)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The words' ids one after another, and how many each has; none if a word is too long to be kept."""
        where = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        self.again[where[where >= 0]] = True
        lacking = np.flatnonzero(where < 0)
        if len(lacking):
            new = list(dict.fromkeys([words[i] for i in lacking.tolist()]))
            if max(map(len, new)) > self.longest:  # never kept, so always among the new
                return None
            if len(self.at) + len(new) > self.size:
                self.keep(self.size // 2)
                new, lacking = [w for w in dict.fromkeys(words) if w not in self.at], np.arange(len(words))
            self._add(new, *self.learn(new))
            where[lacking] = np.fromiter(map(self.at.__getitem__, [words[i] for i in lacking.tolist()]), np.int64, len(lacking))
        counts = self.count[where]
        return self.flat[spread(self.first[where], counts)], counts


class BatchTokenizer:
    """ids(texts) -> one uint32 array a text; equal to the library's own result without special tokens."""

    LONGEST_PIECE = 48

    def __init__(self, vocabulary: str, table_size: int = 400_000):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.lib.encode_special_tokens = True
        self.n_vocab = self.lib.get_vocab_size(with_added_tokens=True)
        self.lower = self.lib.normalizer is not None
        self.pieces = _WORD_PIECES if self.lower else _BYTE_PIECES
        self.edges = np.zeros(self.n_vocab, np.int64)  # tokens that end a word, or that begin with a space
        for token, i in self.lib.get_vocab(with_added_tokens=True).items():
            self.edges[i] = token.endswith("</w>") if self.lower else token.startswith("Ġ")
        self.glue = self.lib.token_to_id("Ċ")
        self.table = IdTable(table_size, self.LONGEST_PIECE, self._learn)
        self.between_space = IdTable(table_size, self.LONGEST_PIECE, self._by_pieces) if self.lower else None

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids one after another, and how many each has."""
        lists = [e.ids for e in self.lib.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in lists for i in ids], np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def _joined(self, words: list[str], glue: str) -> tuple[np.ndarray, np.ndarray]:
        """Like _encoded, but as one text in which each word is a piece of its own: one call instead of thousands. The
        tokens show where words begin or end: by the word-end mark, by the leading space, or by the glue's own token."""
        ids = np.array(self.lib.encode_batch_fast([glue.join(words)], add_special_tokens=False)[0].ids, np.uint32)
        edge = self.edges[ids]
        if self.lower:
            number = np.cumsum(edge) - edge
        elif glue:
            number = np.cumsum(ids == self.glue)[ids != self.glue]
            ids = ids[ids != self.glue]
        else:
            number = np.cumsum(edge) - 1
        counts = np.bincount(number, minlength=len(words)) if len(number) and number[0] == 0 else np.zeros(0, np.int64)
        return (ids, counts) if len(counts) == len(words) and counts.all() else self._encoded(words)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.lower:
            return self._joined(words, " ")
        blank = np.fromiter(map(str.isspace, words), bool, len(words))
        spaced = np.fromiter((w[0] == " " for w in words), bool, len(words)) & ~blank
        counts, parts = np.zeros(len(words), np.int64), []
        for own, how in ((spaced, lambda p: self._joined(p, "")), (blank, self._encoded), (~spaced & ~blank, lambda p: self._joined(p, "\n"))):
            if own.any():
                ids, counts[own] = how([words[k] for k in np.flatnonzero(own).tolist()])
                parts.append((own, ids))
        first, at = np.zeros(len(words), np.int64), 0
        for own, ids in parts:
            first[own] = at + np.cumsum(counts[own]) - counts[own]
            at += len(ids)
        return np.concatenate([ids for _, ids in parts])[spread(first, counts)], counts

    def _by_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = list(map(self.pieces.findall, words))
        ids, counts = self.table.ids(list(chain.from_iterable(pieces)))
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(list(map(len, pieces)))])])

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _from_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """All ids of settled texts one after another, and how many each text has; none if a piece is too long to be kept."""
        pieces = [self.pieces.findall(text.lower() if self.lower else text) for text in texts]
        found = self.table.ids(list(chain.from_iterable(pieces)))
        return found and (found[0], np.diff(np.concatenate([[0], np.cumsum(found[1])])[np.cumsum([0, *map(len, pieces)])]))

    def _from_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same by what stands between white space; none if that is too long to be kept somewhere."""
        words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array([text.lower() for text in texts], pa.string())))
        coded = words.flatten().dictionary_encode()
        found = self.between_space.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if found is None:
            return None
        ids, counts = found
        where = coded.indices.to_numpy()
        each = counts[where]
        return ids[spread((np.cumsum(counts) - counts)[where], each)], np.diff(np.concatenate([[0], np.cumsum(each)])[words.offsets.to_numpy()])

    def ids(self, texts: list[str], fine: bool = False) -> list[np.ndarray]:
        """One array a text. Texts are taken together, so give a block of a few hundred thousand characters. fine: by pieces at once."""
        odd = [k for k, text in enumerate(texts) if _UNSETTLED.search(text)]
        fine = fine or not self.lower
        blanked = list(texts)
        for k in odd:
            blanked[k] = ""
        found = (self._from_pieces if fine else self._from_words)(blanked)
        if found is None:  # texts with very long words go by pieces, those with very long pieces whole, the others again
            parts = self.pieces.findall if fine else str.split
            long = [k for k, text in enumerate(blanked) if max(map(len, parts(text.lower() if self.lower else text)), default=0) > self.LONGEST_PIECE]
            rest = sorted(set(range(len(texts))).difference(long))
            how = self._whole if fine else partial(self.ids, fine=True)
            out = dict(zip(rest, self.ids([texts[k] for k in rest], fine))) | dict(zip(long, how([texts[k] for k in long])))
            return [out[k] for k in range(len(texts))]
        cuts = np.cumsum(found[1]).tolist()
        out = [found[0][a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
        for k, own in zip(odd, self._whole([texts[k] for k in odd])):
            out[k] = own
        return out

    def rest(self) -> None:
        """Empties the tables, for the end of a task: an executor has more workers than run at a time, and those that wait, or go on to other
        work, would each hold them."""
        for table in filter(None, (self.table, self.between_space)):
            table.keep(0)
        pa.default_memory_pool().release_unused()


@lru_cache(maxsize=1)
def tokenizer(vocabulary: str) -> BatchTokenizer:
    """This process's tokenizer: a worker's next task finds the pieces that its last one met, unless that called rest."""
    return BatchTokenizer(vocabulary)


def blocks(texts: Iterable[str | None], most_chars: int = 1 << 19) -> Iterable[list[str]]:
    """Consecutive texts (null as empty) in lists of about most_chars characters, so that long texts don't add up."""
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= most_chars:
            yield part
            part, size = [], 0
    if part:
        yield part
