"""Token ids of whole texts inside Arrow tasks, as the tokenizer libraries give them."""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

#: Words that a worker remembers of late, and as many of before.
REMEMBERED = 150_000
#: ASCII marks that end a word and form one unit of the letters-digits-others pattern.
MARKS = b".,!#%&*$|"
MARKS_BEHIND = re.compile(rb"(?<=[a-z])([.,!#%&*$|]+)(?=\s|\Z)")
#: Special strings, and letters that a mark is to be joined to.
SPECIAL = re.compile(rb"<\||\xcc|\xcd")
OTHERS = r"[^\s\p{L}\p{N}]+"


def file_digest(path: str) -> str:
    """The version of a tokenizer: a digest of its file and of how it is called."""
    with open(path, "rb") as f:
        return hashlib.sha256(b"plain ids, no added tokens\n" + f.read()).hexdigest()


class PieceEncoder:
    """sentencepiece models; the ids of each text as little-endian unsigned 32-bit numbers."""

    words_apart = False

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        ids = self.model.encode([t.decode("utf-8", "replace") for t in texts], num_threads=1, add_bos=False, add_eos=False)
        return [np.asarray(x, "<u4").tobytes() for x in ids]

    def vocabulary_size(self) -> int:
        return self.model.get_piece_size()


class TextEncoder:
    """tokenizers files, each text encoded as a whole."""

    words_apart = False

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def vocabulary_size(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        return self.plain([t.decode("utf-8", "replace") for t in texts])


class WordIds(dict):
    """Ids of words: what was met of late, and before that what is met again; both have ``REMEMBERED`` words at most."""

    def __init__(self, tokenizer, letters: dict[int, str]):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters, self.characters = letters, frozenset(map(chr, letters))
        #: Whether a-z stand for themselves.
        self.plain = all(letters.get(c) == chr(c) for c in range(ord("a"), ord("z") + 1))

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encoded(word)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encoded(self, word: bytes) -> bytes:
        if self.plain and word.isalpha() and word.islower():
            return array("I", [t.id for t in self.model.tokenize(word.decode("ascii"))]).tobytes()
        base = word.rstrip(MARKS)
        text = base.decode("utf-8", "replace")
        if not base or not self.characters.issuperset(text):
            return np.asarray(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        if len(base) < len(word):
            return self[base] + self[word[len(base):]]
        return array("I", [t.id for t in self.model.tokenize(text.translate(self.letters))]).tobytes()


class WordEncoder(TextEncoder):
    """Tokenizers that drop white space: a text's ids are the ids of its words in a row.

    Words are looked up; the library is given those not remembered.  A word of
    letters alone is one unit, which the library's model takes as it is; marks
    after a letter are a unit of their own, so they are looked up apart.
    """

    words_apart = True

    def __init__(self, path: str):
        super().__init__(path)
        with open(path) as f:
            self.known = WordIds(self.tokenizer, single_letters(self.tokenizer, json.load(f)))

    def words(self, text: bytes) -> list[bytes]:
        # Special strings stand as they are written, and a letter's case counts where a mark is to be joined to it.
        if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
            return text.split()
        return MARKS_BEHIND.sub(rb" \1", text.lower()).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        look = self.known.__getitem__
        return [b"".join(map(look, self.words(t))) for t in texts]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each lower-case word by itself; in a row they are those of the text."""
        look = self.known.__getitem__
        return [look(base) + look(w[len(base):]) if len(base := w.rstrip(MARKS)) < len(w) and base[-1:].islower() and not SPECIAL.search(w) else look(w)
                for w in words]


def steps_of(spec: dict | None, name: str) -> list[dict]:
    return (spec or {}).get(name) or ([spec] if spec else [])


def single_letters(tokenizer, spec: dict) -> dict[int, str]:
    """What the library makes of each letter before its model sees it, where it treats letters one by one; else nothing."""
    normal, split, model = steps_of(spec.get("normalizer"), "normalizers"), steps_of(spec.get("pre_tokenizer"), "pretokenizers"), spec["model"]
    if ({s["type"] for s in normal} - {"NFC", "Replace", "Lowercase"} or [s["type"] for s in split] != ["Split", "ByteLevel"]
            or split[1].get("add_prefix_space") or split[1].get("use_regex", True) or model["type"] != "BPE" or model.get("dropout")
            or any(s["type"] == "Replace" and s["pattern"] != {"Regex": r"\s+"} for s in normal)):
        return {}
    out = {}
    # Latin, Greek and Cyrillic: without marks to be joined, one letter's form does not depend on the next.
    for c in range(0x530):
        if unicodedata.category(chr(c)).startswith("L"):
            units = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(chr(c)))
            if len(units) == 1:
                out[c] = units[0][0]
    return out


def drops_white_space(spec: dict) -> bool:
    """White space only separates, letters are lower-cased, and letters, digits and other marks never share a unit."""
    steps = [spec.get("normalizer") or {}, *(spec.get("normalizer") or {}).get("normalizers", [])]
    split = [spec.get("pre_tokenizer") or {}, *(spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    patterns = [s.get("pattern", {}).get("Regex", "") for s in split if s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")]
    plain = all(not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    return (plain and any(s.get("type") == "Lowercase" for s in steps) and any(p.endswith(f"|{OTHERS}") for p in patterns)
            and not any(s.get("type") in ("Prepend", "Metaspace") for s in steps + split))


@lru_cache(maxsize=2)
def encoder(path: str):
    """The encoder of a tokenizer file, kept by the worker across tasks."""
    if path.endswith(".model"):
        return PieceEncoder(path)
    with open(path) as f:
        return (WordEncoder if drops_white_space(json.load(f)) else TextEncoder)(path)


def forget_encoders() -> None:
    """Gives the memory of a worker's encoders back, for tasks that need none."""
    encoder.cache_clear()
