"""What several corpus operators share: tables, the shared folder, token caches."""

from __future__ import annotations

import ctypes
import gc
import json
import re
import tempfile
import unicodedata
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are neither a space nor U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: The same whitespace characters, for splitting.
SPACES = r"[\x20\x09-\x0D]+"
#: Longer words are not remembered.
LONG_WORD = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir, which driver and executors share.

    Where a local session names no such folder (tests), one is set first; a cluster must name its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df into the shared folder and read it back: lineage ends there, and executors may be lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shards_for(rows: DataFrame, least: int = 64, most: int = 4_096) -> int:
    """Shards of a shuffle over packed blocks: two for each partition of the input, so that they grow with it."""
    return min(most, max(least, 2 * rows.rdd.getNumPartitions()))


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path on it, usable from driver and executors alike."""
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def remainder(doc_id: str, modulus: int):
    """crc32 of the id written as text, modulo modulus."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


#: What a tokenizer file must say for its words to be encoded one by one.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Characters that the plain path may take: below the combining marks and in a few alphabets.
PLAIN_LIMIT = 0x530


class WordIds(dict):
    """Ids of whole texts, exactly as the tokenizers library gives them, as bytes of `dtype` per text.

    Where the file says that words are normalised and cut by themselves (WORDWISE), texts are cut at spaces
    and newlines, and pieces and their pre-tokens are remembered, at most two generations of `keep` each.
    A piece of letters, digits and signs that the library lower-cases one by one is cut here and its
    pre-tokens go to the model alone; any other piece goes through the library whole. For any other file,
    whole texts do.
    """

    def __init__(self, path: str, keep: int = 200_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.keep, self.old, self.tokens, self.old_tokens = keep, {}, {}, {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        simple = all(not re.search(r"\s", t["content"]) and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        self.wordwise = simple and spec["post_processor"] is None and all(spec[k] == v for k, v in WORDWISE.items())
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.model = self.tokenizer.model
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for what follows U+00FF.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.alphabet = dict(zip((b for b in range(256) if b not in printable), range(256, 512)))
        kinds: dict[str, list[str]] = {"L": [], "N": [], "": []}
        for c in map(chr, range(0x21, PLAIN_LIMIT)):
            kind = unicodedata.category(c)[0]
            # The capital sigma is lower-cased by its place in a word.
            if kind in "LNPS" and c != "\u03a3" and len(c.lower()) == 1 and unicodedata.normalize("NFC", c) == c and self.tokenizer.normalizer and self.tokenizer.normalizer.normalize_str(c) == c.lower():
                kinds[kind if kind in "LN" else ""].append(re.escape(c))
        letters, digits, signs = ("".join(kinds[k]) for k in ("L", "N", ""))
        self.plain = re.compile(f"[{letters}{digits}{signs}]+").fullmatch
        self.cut = re.compile(f"[{letters}]+|[{digits}]|{CONTRACTIONS}|[{signs}]+").findall

    def _direct(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _token(self, word: str) -> bytes:
        """Ids of one pre-token in lower case."""
        ids = self.tokens.get(word)
        if ids is None:
            ids = self.old_tokens.get(word)
            if ids is None:
                mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
                ids = array(self.dtype.char, [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(word) <= LONG_WORD:
                if len(self.tokens) >= self.keep:
                    self.old_tokens, self.tokens = self.tokens, {}
                self.tokens[word] = ids
        return ids

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            # Most pieces are a word of ASCII letters, some with a full stop or comma behind it.
            if piece.isascii() and piece.isalpha():
                ids = self._token(piece.lower())
            elif piece.isascii() and piece[-1:] in (",", ".") and piece[:-1].isalpha():
                ids = self._token(piece[:-1].lower()) + self._token(piece[-1])
            elif not piece:
                ids = b""
            elif self.plain(piece) and not self.special.search(piece):
                ids = b"".join(map(self._token, self.cut(piece.lower())))
            else:
                ids = self._direct(piece)
        if len(piece) <= LONG_WORD:
            if len(self) >= self.keep:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def __call__(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        for text in texts:
            if self.wordwise:
                yield b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" ")))
            else:
                yield self._direct(text or "")


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The encoder of a Python worker, kept from task to task."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


#: A side is broadcast up to this many narrow rows and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that a task holds few texts as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tidy() -> None:
    """Give back what earlier tasks of this Python worker left: kept encoders, and memory that allocators hold.

    Workers outlive tasks, and an executor's memory holds all of its workers.
    """
    _WORD_IDS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it holds at most `rows` rows; df must be narrow and cheap to count."""
    return F.broadcast(df) if df.count() <= rows else df
