"""Encoding of whole texts with a file of the tokenizers library, one column at a time.

Texts are cut at ASCII white space and every distinct word of a batch is encoded once, without marks at its end; a word
of plain letters goes to the file's model directly. That gives the ids of the whole text for tokenizers that look at
runs of letters and of marks by themselves; ``TextEncoder`` checks this property of the file's parts and otherwise
encodes the texts as they are.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOADED: dict[str, TextEncoder] = {}
_WORD_PARTS = {"NFC", "Lowercase", "Replace", "Split", "ByteLevel"}


def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = TextEncoder(path)
    return _LOADED[path]


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte: itself if it prints, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class TextEncoder:
    CACHE_WORDS = 300_000  # memory bound of the word caches; beyond it they start anew
    TAIL = ".,!?|%$#&*-;:"  # marks that are cut off a word's end and encoded by themselves

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.by_word = self._drops_white_space(parts)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # lower-case letters that need no normalising: a word of them alone is one unit of the model
        self.simple = frozenset(c for c in map(chr, range(0x180)) if c.isalpha() and c == c.lower() and c not in "\u00aa\u00ba\u0149\u017f")
        self._reset()

    @staticmethod
    def _drops_white_space(parts: dict) -> bool:
        norm = (parts.get("normalizer") or {}).get("normalizers", [])
        pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = next((p for p in pre if p["type"] == "Split"), None)
        byte = next((p for p in pre if p["type"] == "ByteLevel"), {})
        plain = all(p["type"] in _WORD_PARTS for p in [*norm, *pre]) and {p["type"] for p in norm} >= {"NFC", "Lowercase"}
        drops = split is not None and split["behavior"] == "Removed" and split["invert"] and "[\\p{L}]+" in split["pattern"].get("Regex", "")
        model = parts["model"]["type"] == "BPE" and not parts["model"].get("dropout")
        return bool(plain and drops and model and not byte.get("add_prefix_space") and not any(t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]))

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("i")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _unit(self, unit: str) -> int:
        """The place of a unit's ids in the tables."""
        at = self.known[unit] = len(self.sizes)
        if not unit:
            ids = []
        elif self.simple.issuperset(unit):
            ids = [t.id for t in self.model.tokenize(unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self._encode([unit])[0]
        self.starts.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat.extend(ids)
        return at

    def _places(self, units: list[str]) -> np.ndarray:
        get, add = self.known.get, self._unit
        return np.asarray([at if (at := get(u)) is not None else add(u) for u in units], np.int64)

    def _halves(self, words: pa.Array) -> np.ndarray:
        """For every distinct word the places of what it says and of the marks at its end (2 columns).

        Marks are separate if a letter or digit stands before them. A-Z are folded here to save units, but not where
        ``<`` may start a special token.
        """
        low = pc.if_else(pc.match_substring(words, "<"), words, pc.ascii_lower(words))
        head = pc.utf8_rtrim(low, characters=self.TAIL)
        core = pc.if_else(pc.match_substring_regex(head, "[a-z0-9\u00df-\u00f6\u00f8-\u00ff]$"), head, low)
        cut = pc.binary_length(core).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(pc.binary_length(low).to_numpy(zero_copy_only=False) > cut)
        cores = core.dictionary_encode()
        tails = pa.array([w.encode()[k:].decode() for w, k in zip(low.take(pa.array(marked)).to_pylist(), cut[marked].tolist(), strict=True)], pa.large_string()).dictionary_encode()
        if len(self.known) + len(cores.dictionary) + len(tails.dictionary) > self.CACHE_WORDS:
            self._reset()
        out = np.full((len(words), 2), self._places([""])[0])
        if len(words):
            out[:, 0] = self._places(cores.dictionary.to_pylist())[cores.indices.to_numpy(zero_copy_only=False)]
        if len(marked):
            out[marked, 1] = self._places(tails.dictionary.to_pylist())[tails.indices.to_numpy(zero_copy_only=False)]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text); null texts count as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            ids = self._encode(texts.to_pylist())
            return np.asarray([i for x in ids for i in x], np.int32), np.asarray([len(x) for x in ids], np.int64)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        halves = self._halves(coded.dictionary)
        flat, starts, sizes = np.array(self.flat, np.int32), np.array(self.starts, np.int64), np.array(self.sizes, np.int64)
        use = halves[coded.indices.to_numpy(zero_copy_only=False)].ravel() if len(halves) else np.empty(0, np.int64)
        size = sizes[use]
        before = np.concatenate([[0], np.cumsum(size)])
        offsets = 2 * words.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        counts = before[offsets[1:]] - before[offsets[:-1]]
        at = np.arange(before[-1]) - np.repeat(before[:-1] - starts[use], size)
        return flat[at], counts


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 6_000_000):
    """The batch in runs of rows whose texts have about ``most_bytes`` together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after every text's, and the numbers of ids with it."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
