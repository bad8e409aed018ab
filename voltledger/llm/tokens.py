"""Loading public tokenizers inside tasks, once per Python worker."""

from __future__ import annotations

import base64
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

WORD_VOCAB = "word_bpe_49k.json"
BYTE_VOCAB = "byte_bpe_50k.tiktoken"
# Bytes of words and their ids kept per worker, and the longest word kept; the table is emptied when full,
# which changes speed only.
CACHE_BYTES, CACHE_LETTERS = 96 << 20, 64
_ENTRY_BYTES = 250  # of an entry, a string and a bytes object, without their content

# Blanks for str.split that the tokenizer's pattern does not count as white space.
_ODD_BLANKS = ("\x1c", "\x1d", "\x1e", "\x1f")
_BLANK = re.compile(r"[ \t\n\r]+")
# A comma or full stop beside another mark.
_TWO_MARKS = re.compile(r"[,.](?:[^\w\s]|_|(?<=[^\w\s].)|(?<=_.))")
# Fixed values of the vocabulary: its pre-token pattern and its mark for the end of a word.
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_WORD_END = "</w>"
# White space of public_tokenizers.PATTERN.  Its part \s+(?!\S) keeps one place per character to go back to
# and fails at a million of them; longer runs than this are cut out before the pattern sees them.
LONG_BLANKS = 100_000
_LONG_BLANKS = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}+" % (LONG_BLANKS + 1))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Ids of whole texts from a word-level BPE that drops white space; a table word -> ids.

    Pre-tokens of this vocabulary never span white space, so the ids of a text are those of its
    words in order, and every word is encoded once.  Merges run in the same vocabulary read as
    byte ranks, with byte 0 for the mark at a word's end, which costs far less per word than a
    call of the tokenizer.  Words with letters beyond U+024F or with byte 0 go to the tokenizer.

    With ``added`` the ids are those of the tokenizer file as it is: a text is cut at the strings of
    its added tokens before anything else, and each stands for its one id.  Without, these strings are
    ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self._held = 0
        self._tokenizer = Tokenizer.from_file(path)
        # Their strings in a word are ordinary text: those of a text are cut out before it is lowered.
        self._tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        marks = whole.get("added_tokens") or [] if added else []
        if any(m[flag] for m in marks for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that take more than their own string are not known here")
        self._added = {m["content"]: struct.pack("<I", m["id"]) for m in marks}
        longest = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if marks else None
        byte_of, ranks, by_name = _byte_of(), {}, model["vocab"]
        for token, rank in by_name.items():
            end = token.endswith(_WORD_END)
            letters = token.removesuffix(_WORD_END)
            if all(c in byte_of for c in letters) and not token.startswith("<|"):
                ranks[bytes(byte_of[c] for c in letters) + b"\0" * end] = rank
        # Ranks must be the order of the merges.
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [by_name[a + b] for a, b in pairs]
        self._fast = None
        if order == sorted(order) and all(by_name[c + e] < order[0] for c in byte_of for e in ("", _WORD_END)):
            self._fast = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
            self._ends = np.zeros(max(ranks.values()) + 1, dtype=bool)
            self._ends[[rank for token, rank in ranks.items() if token.endswith(b"\0")]] = True

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word; all pre-tokens that the byte ranks can express are merged in one call."""
        known, together = None, "".join(words)
        if self._fast is None or "\0" in together or max(together, default="") > "\u024f":
            known = [self._fast is not None and "\0" not in w and max(w, default="") <= "\u024f" for w in words]
        easy = words if known is None else [w for w, k in zip(words, known, strict=True) if k]
        pieces, size = easy, np.ones(len(easy), dtype=np.int64)
        odd = [i for i, alpha in enumerate(map(str.isalpha, easy)) if not alpha]
        if odd:
            split = {i: _PRE_TOKEN.findall(easy[i]) for i in odd}
            size[odd] = [len(x) for x in split.values()]
            pieces = [p for i, w in enumerate(easy) for p in split.get(i, (w,))]
        raw, edges = b"", np.zeros(1, dtype=np.int64)
        if pieces:
            ids = self._fast.encode_to_numpy("\0".join(pieces) + "\0", disallowed_special=())
            raw, edges = ids.astype("<u4").tobytes(), np.concatenate([[0], 4 * np.flatnonzero(self._ends[ids]) + 4])
        cuts = edges[np.concatenate([[0], np.cumsum(size)])].tolist()
        found = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if known is None:
            return found
        rest = iter(found)
        return [next(rest) if k else np.asarray(self._tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
                for w, k in zip(words, known, strict=True)]

    def known(self, words: list[str]) -> list[bytes]:
        """Ids of each of these different words, from the table where it has them."""
        found = list(map(self.get, words))
        new = [w for w, x in zip(words, found, strict=True) if x is None]
        if not new:
            return found
        ids = self._ids(new)
        kept = {w: x for w, x in zip(new, ids, strict=True) if len(w) <= CACHE_LETTERS}
        if self._held >= CACHE_BYTES:
            self.clear()
            self._held = 0
        self.update(kept)
        self._held += _ENTRY_BYTES * len(kept) + 4 * sum(map(len, kept)) + sum(map(len, kept.values()))
        rest = iter(ids)
        return [next(rest) if x is None else x for x in found]

    @staticmethod
    def _spaced(text: str) -> str | None:
        """Lowered text whose words at blanks have, in order, the ids of the text; None if blanks differ."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")  # no special sigma at word ends
        text = text.lower()
        if any(c in text for c in _ODD_BLANKS):
            return None
        if not _TWO_MARKS.search(text):
            # A mark with no other beside it is a pre-token anyway; apart from its word, both are common words.
            text = text.replace(",", " , ").replace(".", " . ")
        return text

    def _alone(self, text: str) -> bytes:
        """Ids of a text with odd blanks or added tokens in it."""
        first, *others = self._cut.split(text) if self._cut else (text,)
        found = []
        for mark, part in zip([None, *others[::2]], [first, *others[1::2]], strict=True):
            spaced = self._spaced(part)
            if spaced is None:
                part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
                words = [w for w in _BLANK.split(part) if w]
            else:
                words = spaced.split()
            found += ([] if mark is None else [self._added[mark]]) + self.known(words)
        return b"".join(found)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text).

        Words are split and numbered by Arrow; every different word is looked up once.
        """
        alone = {i: None for i, t in enumerate(texts) if any(m in t for m in self._added)}
        spaced = [None if i in alone else self._spaced(t) for i, t in enumerate(texts)]
        apart = {i: np.frombuffer(self._alone(texts[i]), dtype="<u4") for i, t in enumerate(spaced) if t is None}
        split = pc.utf8_split_whitespace(pa.array([t or "" for t in spaced], pa.large_string()))
        coded = split.flatten().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        # A text that starts or ends with blanks has an empty word there, without ids.
        known = self.known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        ids, first = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(size) - size
        word = coded.indices.to_numpy(zero_copy_only=False)
        n = size[word]
        upto = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.arange(upto[-1]) + np.repeat(first[word] - upto[:-1], n)]
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        places = upto[edges]
        counts = np.diff(places)
        if apart:
            counts[list(apart)] = [len(x) for x in apart.values()]
            out = np.concatenate([apart.get(i, out[a:b]) for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True))])
        return out, counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        ids, counts = self.flat(texts)
        edges = np.cumsum(counts).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *edges], edges)]


@lru_cache(maxsize=2)
def word_encoder(path: str, added: bool = False) -> WordEncoder:
    return WordEncoder(path, added)


class ByteEncoder:
    """Byte-level BPE that also tells how many bytes of the text each id stands for."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self._encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text.

        A very long run of white space is a pre-token without its last character where something
        follows, and as a whole at the end of the text, so it can be encoded apart.
        """
        held, start = [], 0
        for run in _LONG_BLANKS.finditer(text) if len(text) > LONG_BLANKS else ():
            stop = run.end() - (run.end() < len(text))
            held += self._encoding.encode_ordinary(text[start : run.start()])
            held += self._encoding._encode_single_piece(text[run.start() : stop])
            start = stop
        return np.asarray(held + self._encoding.encode_ordinary(text[start:]), dtype=np.int64)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every token in the text's UTF-8 bytes."""
        ids = self.ids(text)
        ends = np.cumsum(self._lengths[ids])
        return ends - self._lengths[ids], ends


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
