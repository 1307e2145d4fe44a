"""Byte-pair encoding by backtracking, and decoding by an offset table.

For a vocabulary with word ends and lower-case text (a ``tokenizers`` JSON file, read from a
path that is a parameter).  A word is a string over 512 symbols: its bytes, the last of them in
its word-end form.  An Aho-Corasick automaton gives every token that ends at each place; the
encoder walks from the right, takes the longest token first, and steps back where a neighbour
is not compatible.  Two tokens are compatible if the merges of their joint text give back just
these two; exact merging is the one segmentation whose neighbours all are.  Compatibility is
looked up in a table that fills as pairs occur, so work is linear in the text.

Words are kept with their result in a bounded table per task.

Defined results: a null text is empty and gives no ids.  Special-token strings in a text become
their ids, as the library does by default.  Characters younger than the library's Unicode tables may
be cut into words differently.  Rows are independent of each other.
"""

from __future__ import annotations

import json
import re
import unicodedata

import ahocorasick
import regex
from pyspark.sql import Column

from duskwatch.llm.common import per_text

WORD_END = "</w>"
_SPACE = r"\t-\r \x85\xa0  -     　"
# Fixed value: how the vocabulary's file cuts text into words
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+")
# The same for text whose only digits are ASCII and whose letters are Latin, where it is faster
_NOT_LATIN = re.compile("[²³¹¼½¾\u0250-\U0010ffff]")
_LATIN_WORDS = re.compile(
    r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|(?:[^" + _SPACE + r"\w]|_)+"
)
KEPT_WORDS = 400_000


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 0
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(256 + extra)
            extra += 1
    return letters


class _Kept(dict):
    """What ``make`` gives for each key, kept."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def make_room(self) -> None:
        if len(self) > KEPT_WORDS:
            self.clear()


class WordBpe:
    """Encoder and decoder for the vocabulary at ``path``."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary, merges = stored["model"]["vocab"], stored["model"]["merges"]
        special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        symbol = {letter: chr(byte) for byte, letter in enumerate(_byte_letters())}

        def symbols(token: str) -> str:
            ends = token.endswith(WORD_END) and len(token) > len(WORD_END)
            text = "".join(symbol[c] for c in (token[: -len(WORD_END)] if ends else token))
            return text[:-1] + chr(256 + ord(text[-1])) if ends else text

        self.symbols = {number: symbols(token) for token, number in vocabulary.items()}
        self.single = {text: number for number, text in self.symbols.items() if len(text) == 1}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank_of = dict.fromkeys(vocabulary.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            joined = vocabulary[left + right]
            pair = vocabulary[left], vocabulary[right]
            self.ranks[pair], self.rank_of[joined], self.parts[joined] = (rank, joined), rank, pair
        self.automaton = ahocorasick.Automaton()
        for number, text in self.symbols.items():
            self.automaton.add_word(text, (len(text), number))
        self.automaton.make_automaton()
        # decoding: the text of token i is blob[offsets[i]:offsets[i + 1]]
        every = {number: token for token, number in vocabulary.items()}
        every |= {number: text for text, number in special.items()}
        self.offsets, parts, at = [0], [], 0
        for number in range(max(every) + 1):
            parts.append(every.get(number, ""))
            at += len(parts[-1])
            self.offsets.append(at)
        self.blob = "".join(parts)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.compatible: dict[tuple[int, int | None], bool] = {}
        self.whole: dict[int, bool] = {}
        self.ids, self.texts = _Kept(self._ids), _Kept(self._text)

    def merged(self, text: str) -> list[int]:
        """Tokens of a symbol string by merging the pair of least rank, again and again."""
        ids = [self.single[c] for c in text]
        while len(ids) > 1:
            known = [(self.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
            if not known:
                break
            (_, joined), i = min(known)
            ids[i : i + 2] = [joined]
        return ids

    def _stay_apart(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge across the border comes before the two tokens are complete.

        While merges go on, the pieces at the border are on the right edge of ``left``'s tree
        and the left edge of ``right``'s.  Going back in time, the piece made last is the first
        to come apart; of equal merges the one further left is made first.
        """
        rank_of, parts, ranks = self.rank_of, self.parts, self.ranks
        left_ends = right_ends = limit  # rank of the merge that ends each piece
        while True:
            found = ranks.get((left, right))
            if found is not None and found[0] < left_ends and found[0] <= right_ends:
                # at the limit itself this is the merge that makes the token
                if not (found[0] == right_ends == limit):
                    return False
            made_left, made_right = rank_of[left], rank_of[right]
            if made_left > made_right:
                left_ends, left = made_left, parts[left][1]
            elif made_right >= 0:
                right_ends, right = made_right, parts[right][0]
            else:
                return True

    def _alone(self, token: int) -> bool:
        """Whether merging the token's own text gives the token."""
        known = self.whole.get(token)
        if known is None:
            left, right = self.parts.get(token, (None, None))
            known = left is None or (
                self._alone(left)
                and self._alone(right)
                and self._stay_apart(left, right, self.rank_of[token])
            )
            self.whole[token] = known
        return known

    def _fits(self, left: int, right: int | None) -> bool:
        """Whether ``left`` survives merging, alone and before ``right``."""
        return self._alone(left) and (
            right is None or self._stay_apart(left, right, float("inf"))
        )

    def encode_word(self, word: str) -> list[int]:
        data = word.encode()
        text = data[:-1].decode("latin-1") + chr(256 + data[-1])
        ending: list[list[tuple[int, int]]] = [[] for _ in text]
        for last, token in self.automaton.iter(text):  # longest first at each place
            ending[last].append(token)
        compatible = self.compatible
        chosen: list[int] = []
        lengths: list[int] = []
        right, at, options = None, len(text), [iter(ending[-1])]
        dead: set[tuple[int, int]] = set()
        while at:
            for length, token in options[-1]:
                fits = compatible.get((token, right))
                if fits is None:
                    fits = compatible[token, right] = self._fits(token, right)
                if fits and not (dead and (at - length, token) in dead):
                    chosen.append(token)
                    lengths.append(length)
                    right = token
                    at -= length
                    options.append(iter(ending[at - 1]))
                    break
            else:
                if not chosen:
                    raise ValueError(f"the vocabulary has no tokens for {word!r}")
                options.pop()
                dead.add((at, chosen.pop()))
                at += lengths.pop()
                right = chosen[-1] if chosen else None
        chosen.reverse()
        return chosen

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return _LATIN_WORDS.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (_WORDS if _NOT_LATIN.search(text) else _LATIN_WORDS).findall(text)

    def _ids(self, word: str) -> str:
        number = self.special.get(word)
        return " ".join(map(str, self.encode_word(word))) if number is None else str(number)

    def _text(self, word: str) -> str:
        return self.decode([int(i) for i in self.ids[word].split()])

    def _all_words(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order; no plain word equals a special token."""
        if "<|" not in text:
            return self._plain_words(text)
        words, at = [], 0
        for m in self.cut.finditer(text):
            words += [*self._plain_words(text[at : m.start()]), m[0]]
            at = m.end()
        return words + self._plain_words(text[at:])

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for w in self._all_words(text or "") for i in self.ids[w].split()]

    def decode(self, ids: list[int]) -> str:
        """Texts of the tokens, a space between them (the file names no decoder)."""
        blob, offsets = self.blob, self.offsets
        return " ".join([blob[offsets[i] : offsets[i + 1]] for i in ids])

    def encoded(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, the ids with spaces between them, and the text they decode to."""
        words = self._all_words(text or "")
        for kept in (self.ids, self.texts):
            kept.make_room()
        ids = " ".join([self.ids[w] for w in words])
        decoded = " ".join([self.texts[w] for w in words])
        return ids.count(" ") + 1 if words else 0, ids, decoded


def load(path: str) -> WordBpe:
    """The vocabulary at ``path``.

    A task reads its own and lets go of it: Spark keeps more idle workers than it has cores, and a
    vocabulary with the words met so far would stay in each of them beside the next stage's work.
    """
    return WordBpe(path)


def token_digests(text: Column, path: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of a text column."""
    from hashlib import sha256

    def make():
        bpe = load(path)

        def one(value):
            count, ids, decoded = bpe.encoded(value)
            return count, sha256(ids.encode()).hexdigest(), sha256(decoded.encode()).hexdigest()

        return one

    return per_text(make, "n_tokens long, ids_sha256 string, decoded_sha256 string")(text)


def tokens(text: Column, path: str) -> Column:
    """Struct (n_tokens, ids, decoded): ids space-joined, decoded the text they stand for."""

    def make():
        return load(path).encoded

    return per_text(make, "n_tokens long, ids string, decoded string")(text)
