"""Token ids of whole texts with a public byte-level BPE tokenizer of the tokenizers library.

A byte-level BPE never joins characters across a single blank, or a single line break, between two visible characters: such a blank
starts a new piece and such a line break is a piece. Texts are cut at these places only, each distinct piece is encoded once while it is
known (bounded memory, kept between the tasks of a worker; when it is full, the pieces seen in two or more calls stay), and the ids are
gathered. The result equals encoding the whole text; tests
compare the two.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
OTHER_BLANK = re.compile(r"[^\S \n]")
BLANK_RUNS = ("  ", " \n", "\n ", "\n\n")
KNOWN_PIECES = 500_000
JOINED = 400
# A letter run and one of these signs after it are pieces of their own.
SIGNS = ".,;:!?)"


@lru_cache(maxsize=1)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def plain_blanks(text: str) -> bool:
    """Only single blanks and line breaks, each between two visible characters."""
    return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and not any(b in text for b in BLANK_RUNS) and not OTHER_BLANK.search(text)


def cut(text: str) -> list[str]:
    """The pieces of any text, cut at single blanks; joined they are the text."""
    parts = SINGLE_BLANK.split(text)
    return [parts[0], *[" " + p for p in parts[1:]]]


class PieceEncoder:
    """Ids of many texts, each closed by the end id.

    `after_blank` knows words that follow a blank, `at_start` words at the start of a line and the pieces of irregular texts.
    """

    def __init__(self, path: str, end_id: int):
        self.path, self.end_id = path, end_id
        self.line_break = tokenizer(path).encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.after_blank: dict[str, int] = {}
        self.at_start: dict[str, int] = {}
        start = np.array([self.end_id, *self.line_break], np.uint32)  # place 0: the end; place 1: a line break
        self.flat, self.first, self.size = start, np.array([0, 1]), np.array([1, len(start) - 1])
        self.calls = np.zeros(2, np.int32)

    def forget(self) -> None:
        """Keep the pieces that were asked for in most calls: those of two or more, or of so many more that they fill half the room."""
        calls, least = self.calls, 2
        while np.count_nonzero(calls >= least) > KNOWN_PIECES // 2:
            least += 1
        stay = calls >= least
        stay[:2] = True
        place = np.cumsum(stay) - 1
        for name in ("after_blank", "at_start"):
            known = getattr(self, name)
            setattr(self, name, {w: int(place[i]) for w, i in known.items() if stay[i]})
        sizes = self.size[stay]
        ends = np.cumsum(sizes)
        self.flat = self.flat[np.repeat(self.first[stay] - ends + sizes, sizes) + np.arange(ends[-1])]
        self.first, self.size, self.calls = ends - sizes, sizes, np.zeros(len(sizes), np.int32)

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and their numbers."""
        found = [e.ids for e in tokenizer(self.path).encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces without inner blanks, many in one text: a line break after each marks its end."""
        if len(self.line_break) == 1 and not any("<|" in w for w in words):
            lines = ["\n".join(words[i : i + JOINED]) + "\n" for i in range(0, len(words), JOINED)]
            ids, _ = self.encoded(lines)
            marks = np.nonzero(ids == self.line_break[0])[0]
            if len(marks) == len(words):
                return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1
        return self.encoded(words)

    def add(self, known: dict[str, int], names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        begin = len(self.size)
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.size = np.concatenate([self.flat, ids]), np.concatenate([self.size, sizes])
        self.calls = np.concatenate([self.calls, np.zeros(len(sizes), np.int32)])
        known.update(zip(names, range(begin, begin + len(names)), strict=True))

    def learn(self, known: dict[str, int], words: list[str], before: str) -> None:
        """Add the words that are not known yet. A word that is letters and one sign is put together from its parts."""
        fresh = [w for w in words if w not in known]
        signed = [w for w in fresh if w[-1] in SIGNS and w[:-1].isalpha()]
        apart = set(signed)
        plain = list({w[:-1] for w in signed if w[:-1] not in known}.union(w for w in fresh if w not in apart))
        if plain:
            self.add(known, plain, *self.encoded_words([before + w for w in plain]))
        if signed:
            sign, sizes = self.encoded(list(SIGNS))
            places = np.fromiter((known[w[:-1]] for w in signed), np.int64, len(signed))
            last = np.fromiter((SIGNS.index(w[-1]) for w in signed), np.int64, len(signed))
            if (sizes != 1).any():
                self.add(known, signed, *self.encoded_words([before + w for w in signed]))
                return
            sizes = self.size[places] + 1
            at = np.cumsum(sizes)
            ids = self.flat[np.minimum(np.repeat(self.first[places] - at + sizes, sizes) + np.arange(at[-1]), len(self.flat) - 1)]
            ids[at - 1] = sign[last]
            self.add(known, signed, ids, sizes)

    def places_of(self, known: dict[str, int], words: pa.Array, before: str) -> np.ndarray:
        """The place of every word; only distinct words become Python strings."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(known, distinct, before)
        table = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        self.calls[table] += 1
        return table[coded.indices.to_numpy()]

    def regular(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pieces of texts with plain blanks, and where each text ends among them."""
        lines = pc.split_pattern(pa.array(texts, pa.large_string()), "\n")
        per_text = lines.value_lengths().to_numpy()
        words = pc.split_pattern(lines.flatten(), " ")
        ends = np.cumsum(words.value_lengths().to_numpy(), dtype=np.int64)
        count = len(ends)
        flat, head = words.flatten(), np.zeros(int(ends[-1]), bool)
        head[ends[:-1]] = True
        head[0] = True
        order = np.ones(len(head) + count, np.int64)  # a line break after each line, until something else is put there
        stops = ends + np.arange(count)
        word = np.ones(len(order), bool)
        word[stops] = False
        inner = np.empty(len(head), np.int64)
        inner[head] = self.places_of(self.at_start, flat.filter(pa.array(head)), "")
        inner[~head] = self.places_of(self.after_blank, flat.filter(pa.array(~head)), " ")
        order[word] = inner
        last = stops[np.cumsum(per_text) - 1]
        order[last] = 0
        return order, last + 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of each text's ids, the end id included."""
        if len(self.size) > KNOWN_PIECES:
            self.forget()
        plain = [i for i, text in enumerate(texts) if plain_blanks(text)]
        runs: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        if plain:
            order, ends = self.regular([texts[i] for i in plain])
            for i, part in zip(plain, np.split(order, ends[:-1]), strict=True):
                runs[i] = part
        if len(plain) < len(texts):
            cuts = {i: cut(text) for i, text in enumerate(texts) if not len(runs[i])}
            odd = [p for p in dict.fromkeys(chain.from_iterable(cuts.values())) if p not in self.at_start]
            if odd:
                self.add(self.at_start, odd, *self.encoded(odd))
            for i, parts in cuts.items():
                runs[i] = np.array([*map(self.at_start.__getitem__, parts), 0], np.int64)
        places = np.concatenate(runs)
        sizes = self.size[places]
        at = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.first[places] - at + sizes, sizes) + np.arange(at[-1])]
        return ids, np.diff(at[np.cumsum([len(r) for r in runs]) - 1], prepend=0)


@lru_cache(maxsize=1)
def piece_encoder(path: str, end_id: int) -> PieceEncoder:
    """The worker's encoder; what it knows serves its later tasks too."""
    return PieceEncoder(path, end_id)
