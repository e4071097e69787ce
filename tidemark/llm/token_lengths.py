"""Token ids of whole texts from a public tokenizer, a distinct word at a time."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A longer text is cut after white space into stretches of about this many characters.
STRETCH = 3_000_000
# Beyond so many words, bytes of ids or pieces the rare ones are forgotten.
_MANY_WORDS, _MANY_BYTES, _MANY_PIECES = 600_000, 20_000_000, 300_000
_BLANK = re.compile(r"[ \t-\r]")
# Words whose normal form is themselves: printable ASCII and Latin-1 letters.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: what the tokenizer's own pattern finds in these, lower-cased.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-z0-9à-öø-ÿß]+")


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable
    Latin-1 stands for itself, the other bytes follow from 256 on."""
    itself = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in itself else next(others)) for b in range(256)]


_LETTER = _byte_letters()
# Other words encoded at once.
_TOGETHER = 200


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class WordIds:
    """Ids of texts, put together from the ids of their words.

    The tokenizer drops white space and joins nothing across it, and neither its
    normal form nor its lower case looks across an ASCII blank. So the ids of a
    text are those of its blank-separated words in a row, and each distinct word
    is encoded once. The pieces of a word of ASCII and Latin-1 letters go straight
    to the tokenizer's model, and other words are encoded many at a time. ``tests``
    compare this with encoding whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A special token's name in a text is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self._start()

    def _start(self) -> None:
        self.number: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}
        # Ids of all known words in a row, where each word's end, and in how many
        # stretches each was met.
        self.ids, self.ends, self.met = bytearray(), array("q", [0]), array("i")

    def _add(self, words: list[str], ids: list[bytes]) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(ids))))
        self.ends.extend(accumulate((len(i) // 4 for i in ids), initial=self.ends.pop()))
        self.ids += b"".join(ids)
        self.met.extend([0] * len(ids))

    def _forget(self) -> None:
        """Keep the words that came up again, if they are not too many themselves."""
        ends, ids = self.ends, bytes(self.ids)
        again = [(w, ids[4 * ends[i] : 4 * ends[i + 1]]) for w, i in self.number.items() if self.met[i] > 1]
        self._start()
        if len(again) < _MANY_WORDS // 2 and sum(len(i) for _, i in again) < _MANY_BYTES // 2:
            self._add([w for w, _ in again], [i for _, i in again])

    def _simple(self, words: list[str]) -> Iterator[bytes]:
        known, tokenize = self.pieces, self.model.tokenize
        if len(known) > _MANY_PIECES:
            known.clear()
        for word in words:
            out = []
            for piece in _PIECE.findall(word.lower()):
                ids = known.get(piece)
                if ids is None:
                    letters = piece if piece.isascii() else "".join([_LETTER[b] for b in piece.encode()])
                    ids = known[piece] = array("I", [t.id for t in tokenize(letters)]).tobytes()
                out.append(ids)
            yield b"".join(out)

    def _others(self, words: list[str]) -> Iterator[bytes]:
        for i in range(0, len(words), _TOGETHER):
            some = words[i : i + _TOGETHER]
            found = self.tokenizer.encode("\n".join(some), add_special_tokens=False)
            ids, begins = array("I", found.ids).tobytes(), [begin for begin, _ in found.offsets]
            # A token belongs to the word that its first character lies in.
            ends = list(accumulate(len(w) + 1 for w in some))
            cuts = [0, *(4 * np.searchsorted(begins, ends)).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield ids[a:b]

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > _MANY_WORDS or len(self.ids) > _MANY_BYTES:
            self._forget()
        new = [w for w in words if w not in self.number]
        simple = _SIMPLE.fullmatch
        plain = [w for w in new if simple(w)]
        others = [w for w in new if not simple(w)] if len(plain) < len(new) else []
        self._add(plain + others, [*self._simple(plain), *self._others(others)])
        number = np.array(list(map(self.number.__getitem__, words)), np.int64)
        np.frombuffer(self.met, np.int32)[number] += 1
        return number

    def _together(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        split = pc.ascii_split_whitespace(texts)
        per_text = np.asarray(pc.list_value_length(split), np.int64)
        words = split.flatten().dictionary_encode()
        number = self._numbers(words.dictionary.to_pylist())
        ends, ids = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.uint32)
        at = number[np.asarray(words.indices, np.int64)]
        source, length = ends[at], ends[at + 1] - ends[at]
        goal = np.cumsum(length) - length
        # Both are far below 2^31: a stretch and the known words are bounded.
        out = ids[np.repeat((source - goal).astype(np.int32), length) + np.arange(int(length.sum()), dtype=np.int32)]
        del ends, ids
        ends = np.cumsum(per_text)
        total = np.concatenate([[0], np.cumsum(length)])
        return out, total[ends] - total[ends - per_text]

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; NULL has none."""
        texts = texts.fill_null("")
        size = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
        at = 0
        while at < len(texts):
            base = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, base + STRETCH, "right")))
            if size[end - 1] - base > STRETCH:
                text = texts[at].as_py()
                yield np.concatenate([self._together(pa.array([part]))[0] for part in stretches(text)])
            else:
                out, count = self._together(texts.slice(at, end - at))
                yield from np.split(out, np.cumsum(count)[:-1])
            at = end


def stretches(text: str) -> Iterator[str]:
    """The text in parts that end after a blank; a part without one is not cut."""
    at = 0
    while at < len(text):
        found = _BLANK.search(text, at + STRETCH)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
