"""Split whole batches of text into pre-tokens with numpy and encode each distinct one once.

A byte-pair vocabulary never merges across pre-tokens, so a text's ids are those of its
pre-tokens in order. The split follows the two patterns below character by character
class; each distinct pre-token of a batch is looked up in a cache of the Python worker and
encoded only if it is not there. The cache is emptied at ``CACHE_WORDS`` entries, which
bounds memory and never changes a result.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 600_000
CHUNK_CHARS = 600_000

# The pre-token patterns of the two vocabulary files.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

OTHER, LETTER, NUMBER, SPACE = range(4)
_SPACES = "\t\n\v\f\r \x85\xa0     　" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    table[[ord(c) for c in _SPACES]] = SPACE
    return table


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


def normalise_word_text(text: str) -> str:
    """Compose and lower-case character by character (so no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def split_points(cp: np.ndarray, doc_starts: np.ndarray, words: bool):
    """Start, end and class of every pre-token of texts laid end to end.

    ``cp`` holds code points, ``doc_starts`` the first position of each non-empty text.
    """
    n = len(cp)
    kind = _classes()[cp]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    first[n] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    if words:
        start[:n] |= kind == NUMBER
    else:
        edge = np.flatnonzero(start)
        space = kind[edge[:-1]] == SPACE
        begin, end = edge[:-1][space], edge[1:][space]
        inner = ~first[end]  # something other than white space follows in the same text
        begin, end = begin[inner], end[inner]
        start[end[end - begin > 1] - 1] = True
        start[end[cp[end - 1] == 0x20]] = False
    # A lone apostrophe before a letter may begin one of the listed endings.
    quote = np.flatnonzero(start[:n] & (cp == 0x27))
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
    if len(quote):
        one = np.isin(cp[quote + 1], [ord(c) for c in "stmd"])
        third = np.where((quote + 2 < n) & ~first[np.minimum(quote + 2, n)], cp[np.minimum(quote + 2, n - 1)], 0)
        two = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (cp[quote + 1] == ord(a)) & (third == ord(b))
        start[quote[one | two] + 1] = False
        start[quote[one] + 2] = True
        start[quote[two] + 3] = True
    at = np.flatnonzero(start)
    begin, end = at[:-1], at[1:]
    if words:
        keep = kind[begin] != SPACE
        begin, end = begin[keep], end[keep]
    return begin, end


def _keys(cp: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key per pre-token, from mixed code points and odd powers by position."""
    size = end - begin
    ends = np.cumsum(size)
    local = np.arange(ends[-1]) - np.repeat(ends - size, size)
    # Pre-tokens of a byte vocabulary leave nothing out between them.
    if ends[-1] != len(cp):
        cp = cp[np.repeat(begin, size) + local]
    with np.errstate(over="ignore"):
        mixed = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        power = np.full(int(size.max()), np.uint64(0xD6E8FEB86659FD93))
        power[0] = 1
        power = np.multiply.accumulate(power)
        key = np.add.reduceat(mixed * power[local], ends - size)
        key ^= size.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return key


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and for every key the number of its place."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    new = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


class BatchEncoder:
    """Encodes lists of texts; ``encode_words`` turns distinct pre-tokens into id lists, or
    into the bytes of their unsigned 32-bit ids.

    ``whole`` encodes one text by itself and serves texts that hold a special string.
    """

    def __init__(
        self,
        words: bool,
        encode_words: Callable[[list[str]], list[list[int]] | list[bytes]],
        whole: Callable[[str], list[int]],
        special: tuple[str, ...],
        cache_words: int = CACHE_WORDS,
        chunk_chars: int = CHUNK_CHARS,
    ):
        self.words, self.encode_words, self.whole, self.special = words, encode_words, whole, special
        self.cache_words, self.chunk_chars = cache_words, chunk_chars
        self.cache: dict[str, bytes] = {}

    def _look_up(self, found: list[str]) -> list[bytes]:
        out = list(map(self.cache.get, found))
        missing = [i for i, b in enumerate(out) if b is None]
        if missing:
            if len(self.cache) + len(missing) > self.cache_words:
                self.cache.clear()
            new = [found[i] for i in missing]
            for i, w, ids in zip(missing, new, self.encode_words(new)):
                out[i] = self.cache[w] = ids if type(ids) is bytes else array("I", ids).tobytes()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        counts = np.zeros(len(texts), np.int64)
        parts: dict[int, np.ndarray] = {}
        plain, odd = [], {}
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                odd[i] = np.array(self.whole(t), np.uint32)
                counts[i] = len(odd[i])
                t = ""
            elif self.words:
                t = normalise_word_text(t)
            plain.append(t)
        joined = "".join(plain)
        ids = np.zeros(0, np.uint32)
        if joined:
            sizes = np.fromiter(map(len, plain), np.int64, len(plain))
            cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            begins = np.cumsum(sizes) - sizes
            begin, end = split_points(cp, begins[sizes > 0], self.words)
            if len(begin):
                first, inverse = _distinct(_keys(cp, begin, end))
                found = [joined[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
                each = self._look_up(found)
                flat = np.frombuffer(b"".join(each), np.uint32)
                long = np.fromiter(map(len, each), np.int64, len(each)) // 4
                at = np.cumsum(long) - long
                n = long[inverse]
                out_end = np.cumsum(n)
                ids = flat[np.repeat(at[inverse] - (out_end - n), n) + np.arange(out_end[-1])]
                before = np.concatenate([[0], out_end])
                cut = np.searchsorted(begin, np.concatenate([begins, [len(cp)]]))
                counts += np.diff(before[cut])
        if odd:
            pieces, at = [], 0
            for i, n in enumerate(counts.tolist()):
                if i in odd:
                    pieces.append(odd[i])
                else:
                    pieces.append(ids[at : at + n])
                    at += n
            ids = np.concatenate(pieces) if pieces else ids
        return ids, counts

    def chunks(self, texts: pa.Array | list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, last text, ids, counts), each over about ``chunk_chars`` bytes of text.

        Only the texts of one chunk are taken out of an Arrow array at a time.
        """
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        a = size = 0
        for b, n in enumerate(pc.binary_length(column).to_numpy().tolist(), 1):
            size += n
            if size >= self.chunk_chars or b == len(column):
                yield a, b, *self.encode(column.slice(a, b - a).to_pylist())
                a, size = b, 0


@lru_cache(4)
def library_encoder(path: str, cache_words: int = CACHE_WORDS, chunk_chars: int = CHUNK_CHARS) -> BatchEncoder:
    """Encoder over a vocabulary file of the tokenizers library, one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    words = tok.normalizer is not None
    special = tuple(t.content for t in tok.get_added_tokens_decoder().values())

    def encode_words(found: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast(found, add_special_tokens=False)]

    if not words:
        alphabet, tokenize = np.array([ord(c) for c in byte_letters()], np.uint32), tok.model.tokenize

        def encode_words(found: list[str]) -> list[bytes]:
            """A pre-token goes straight to the model of the library, in the letters of its bytes."""
            data = np.frombuffer("".join(found).encode("utf-8", "surrogatepass"), np.uint8)
            letters = alphabet[data].tobytes().decode("utf-32-le")
            places = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
            word_ends = places[np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))].tolist()
            ids: list[int] = []
            ends = []
            for a, b in zip([0, *word_ends], word_ends):
                ids += [t.id for t in tokenize(letters[a:b])]
                ends.append(4 * len(ids))
            flat = array("I", ids).tobytes()
            return [flat[a:b] for a, b in zip([0, *ends], ends)]

    return BatchEncoder(words, encode_words, lambda t: tok.encode(t, add_special_tokens=False).ids, special, cache_words, chunk_chars)
