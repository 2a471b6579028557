"""Token ids of whole texts by the tokenizers library, which encodes each different word of a worker's texts once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortloom.llm.common import kept

#: Where a text can be cut and encoded in parts: before white space that follows something else, and before a stop or
#: comma that follows a Latin letter or digit (some other letters' small forms end in a mark, which stays with it). No pre-tokenizer of the supported kinds makes a piece that goes on over
#: such a place, and normalizers don't look past it.
CUT = re.compile(r"(?<=\S)(?=[ \t-\r])|(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,])")
#: The second kind of place, as what stands behind it.
STOP = re.compile(r"[.,](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ][.,])")
#: Stands at these places; not a printable character.
MARK = "\0"
#: Parts that are one word each, of which many can be encoded as one text.
WORD = re.compile(r"[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+")
WORDS = re.compile(f"(?<=\0){WORD.pattern}(?=\0)")
#: Pre-tokenizers and normalizers for which that holds.
SPLITTERS = {"ByteLevel", "Split", "Sequence"}
NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace", "Sequence"}
#: What holds within the fixed patterns of splitting and replacing: white space never stands in a piece but at its start.
PATTERNS = {
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    r"\s+",
}
HELD = 400_000  # parts that a worker holds, about 90 MB; when they are as many they are forgotten
LONGEST = 40  # characters of a part that is held
CHARACTERS = 1 << 21  # of texts that are in parts at once, or one text
AT_ONCE = 4096  # parts that the library is given at once
JOINED = 256  # parts that are encoded as one text


def _kinds(part: dict | None) -> Iterable[dict]:
    """A pre-tokenizer or normalizer and what it is made of."""
    if part:
        yield part
        for inner in (*part.get("pretokenizers", ()), *part.get("normalizers", ())):
            yield from _kinds(inner)


def can_be_cut(spec: dict) -> bool:
    """Whether texts may be encoded in parts: the file has none but known ways to normalize and split."""
    for part in _kinds(spec.get("pre_tokenizer")):
        pattern = part.get("pattern", {}).get("Regex")
        if part["type"] not in SPLITTERS or (part["type"] == "Split" and pattern not in PATTERNS):
            return False
        if part["type"] == "ByteLevel" and part.get("add_prefix_space"):
            return False
    for part in _kinds(spec.get("normalizer")):
        pattern = part.get("pattern", {}).get("Regex")
        if part["type"] not in NORMALIZERS or (part["type"] == "Replace" and pattern not in PATTERNS):
            return False
    return bool(spec.get("pre_tokenizer")) and not any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])


def marked_parts(text: str) -> str | None:
    """A text with ``MARK`` at every place of ``CUT``, or None if it isn't as most are.

    In those spaces and line ends all stand alone, so that not each place need be looked at.
    """
    line = text.replace("\n", " ")
    if not line.isprintable() or "  " in line or line.startswith(" "):
        return None
    marked = STOP.sub(f"{MARK}\\g<0>", text) if "." in text or "," in text else text
    return marked.replace(" ", f"{MARK} ").replace("\n", f"{MARK}\n")


def parts_of(text: str) -> list[str]:
    """A text cut at every place of ``CUT``."""
    marked = marked_parts(text)
    return CUT.split(text) if marked is None else marked.split(MARK)


def words_among(parts: list[str]) -> list[str]:
    """Those of ``parts`` that are a ``WORD``."""
    joined = MARK.join(["", *parts, ""])
    if joined.count(MARK) == len(parts) + 1:
        return WORDS.findall(joined)
    return [p for p in parts if WORD.fullmatch(p)]


def _strings(found: pa.Array) -> list[str]:
    """Strings of Arrow as a list; by one long string, if none has a ``MARK``."""
    if not len(found) or pc.any(pc.match_substring(found, MARK)).as_py():
        return found.to_pylist()
    every = pa.ListArray.from_arrays([0, len(found)], found)
    return pc.binary_join(every, pa.scalar(MARK, found.type))[0].as_py().split(MARK)


def word_marks(spec: dict, tokenizer) -> tuple[np.ndarray, bool] | None:
    """Which ids stand at one end of every word, and whether that is its first id; None if unknown for this file.

    Words are those of ``WORD``: each is one piece, which opens with the byte of its space (a line end is a piece of
    its own before it) or closes with the model's suffix.
    """
    suffix, pre = spec["model"].get("end_of_word_suffix"), spec["pre_tokenizer"]
    if any(re.fullmatch(r"[A-Za-zÀ-ÖØ-öø-ÿ \n]+", t["content"]) for t in spec["added_tokens"]):
        return None
    if pre["type"] == "ByteLevel" and pre.get("use_regex", True) and not suffix and not spec.get("normalizer"):
        opens = True
    elif suffix and pre["type"] == "Sequence" and pre["pretokenizers"][0].get("behavior") == "Removed":
        opens = False
    else:
        return None
    marks = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        marks[i] = token.startswith(("Ġ", "Ċ")) if opens else token.endswith(suffix)
    return marks, opens


class Encoder:
    """Ids of one tokenizer file without special tokens added, all of them made by the tokenizers library.

    Texts are cut before white space. The library is given each part that the worker hasn't met, many at
    a time, and a text's ids are those of its parts. Where a file's ways to split aren't known to
    allow that, texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cut = can_be_cut(spec)
        self.marks = word_marks(spec, self.tokenizer) if self.cut else None
        self.held: dict[str, bytes] = {}

    def _encoded(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts, as bytes: words joined, where it is known which ids open or close one, others as a list."""
        out: dict[str, bytes] = {}
        if self.marks:
            words = words_among(parts)
            for at in range(0, len(words), AT_ONCE):
                self._joined(words[at : at + AT_ONCE], out)
            if len(out) < len(parts):
                parts = [p for p in parts if p not in out]
        for at in range(0, len(parts), AT_ONCE):
            self._listed(parts[at : at + AT_ONCE], out)
        return out

    def _joined(self, words: list[str], out: dict[str, bytes]) -> None:
        """Encodes words as texts of ``JOINED`` words; words that can't be told apart are left out."""
        marks, opens = self.marks
        width = np.dtype(self.dtype).itemsize
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            (found,) = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            data = ids.tobytes()
            places = np.flatnonzero(marks[ids])
            bounds = [*(width * places).tolist(), len(data)] if opens else [0, *(width * (places + 1)).tolist()]
            if len(bounds) == len(some) + 1 and bounds[0] == 0 and bounds[-1] == len(data):
                out.update(zip(some, map(data.__getitem__, map(slice, bounds, bounds[1:]))))

    def _listed(self, parts: list[str], out: dict[str, bytes]) -> None:
        """Encodes a list as words cut beforehand; each id tells its word."""
        found = self.tokenizer.encode(parts, is_pretokenized=True, add_special_tokens=False)
        data = np.array(found.ids, self.dtype).tobytes()
        width = np.dtype(self.dtype).itemsize
        ends = width * np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(parts)), side="right")
        start = 0
        for part, end in zip(parts, ends.tolist()):
            out[part] = data[start:end]
            start = end

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def ids_of(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        texts = [t or "" for t in texts]
        if not self.cut:
            return [self._whole(t) if t else np.zeros(0, self.dtype) for t in texts]
        marked = [marked_parts(t) if t else None for t in texts]
        plain = [k for k, m in enumerate(marked) if m is not None]
        odd = [k for k, m in enumerate(marked) if m is None and texts[k]]
        cut = pc.split_pattern(pa.array([marked[k] for k in plain], pa.large_string()), MARK)
        others = [CUT.split(texts[k]) for k in odd]
        # Different parts are looked up; how they follow one another stays in Arrow.
        coded = pa.concat_arrays(
            [cut.flatten(), pa.array([p for own in others for p in own], pa.large_string())]
        ).dictionary_encode()
        found = self._looked_up(_strings(coded.dictionary))
        joined = pa.array(found, pa.large_binary()).take(coded.indices)
        _, places, data = joined.buffers()
        ids = np.frombuffer(data, self.dtype) if data else np.zeros(0, self.dtype)
        places = np.frombuffer(places, np.int64, len(joined) + 1) // ids.itemsize if len(joined) else np.zeros(1, np.int64)
        many = np.concatenate([pc.list_value_length(cut).to_numpy(), [len(own) for own in others]]).astype(np.int64)
        bounds = places[np.concatenate([[0], np.cumsum(many)])].tolist()
        out = [ids[:0]] * len(texts)
        for k, start, end in zip([*plain, *odd], bounds, bounds[1:]):
            out[k] = ids[start:end]
        return out

    def _looked_up(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts, as bytes; those that aren't held are encoded, and held from then on."""
        held = self.held
        found = [*map(held.get, parts)]
        more = self._encoded([p for p, ids in zip(parts, found) if ids is None])
        if more:
            if len(held) + len(more) > HELD:
                held = {p: ids for p, ids in zip(parts, found) if ids is not None}
            held.update((p, ids) for p, ids in more.items() if len(p) <= LONGEST)
            self.held = held if len(held) <= HELD else {}
            found = [more[p] if ids is None else ids for p, ids in zip(parts, found)]
        return found

    def ids(self, text: str | None) -> np.ndarray:
        return self.ids_of([text])[0]

    def each(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn; about ``CHARACTERS`` of texts are in parts at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= CHARACTERS:
                yield from self.ids_of(some)
                some, size = [], 0
        yield from self.ids_of(some)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, kept between tasks that encode."""
    return kept(f"encoder of {path}", lambda: Encoder(path))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
