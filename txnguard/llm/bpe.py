"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 7).

For every prefix of a byte string the last token of its one valid encoding is stored. A longer prefix is
solved from shorter ones: among the tokens that end it, exactly one is compatible with the last token of
what stands before. Appending therefore never changes earlier entries, and after an edit only the entries
from the edit to the next agreement with the old ones are computed again.

Texts are cut by the pre-splitting pattern; each match is encoded on its own. Since no match crosses a
space that follows a non-space, whole batches are encoded by distinct words (``wordwise``).

Defined results: null and empty texts have no ids and decode to the empty text; rows are independent, so
repeated rows and ids give repeated results; extra columns are not read. A document of any length is one
row; no part of it is cut.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from txnguard.llm.wordwise import WordCache, encode_texts, slices, whole_texts


#: Pairs of tokens whose compatibility one worker remembers (about 200 bytes each), and words that start a text.
PAIRS = 500_000
FIRST_WORDS = 50_000


class PrefixBPE:
    """Encoder over a rank file (base64 token, rank per line)."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        sizes: dict[bytes, set[int]] = {}
        for t in self.ranks:
            if len(t) > 2:
                sizes.setdefault(t[-3:], set()).add(len(t))
        #: last three bytes -> sizes of the tokens that may end with them, longest first
        self.ends = {t: (*sorted(n, reverse=True), 2, 1) for t, n in sizes.items()}
        self.pattern = regex.compile(pattern)
        self.fits: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Encoding of a short byte string by its definition: merge the lowest-ranked neighbours."""
        parts, ranks = [data[i:i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, joined, are encoded as just these two."""
        ok = self.fits.get((left, right))
        if ok is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            ok = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            self.fits[left, right] = ok
        return ok

    def stands_alone(self, token: int) -> bool:
        ok = self.alone.get(token)
        if ok is None:
            ok = self.alone[token] = self.merged(self.tokens[token]) == [token]
        return ok

    def extend(self, data: bytes, last: list[int], to: int) -> list[int]:
        """Fill ``last`` (last[i]: last token of the encoding of data[:i + 1]) up to data[:to]."""
        ranks, fits, ends = self.ranks, self.fits, self.ends
        for end in range(len(last) + 1, to + 1):
            for size in ends.get(data[end - 3:end], (2, 1)) if end > 2 else (2, 1):
                start = end - size
                token = ranks.get(data[start:end]) if start >= 0 else None
                if token is None:
                    continue
                if start == 0:
                    if self.stands_alone(token):
                        break
                else:
                    ok = fits.get((last[start - 1], token))
                    if ok or ok is None and self.may_follow(last[start - 1], token):
                        break
            else:
                raise ValueError("no valid last token: the rank file is not a byte-level BPE vocabulary")
            last.append(token)
        return last

    def walk(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.walk(self.extend(data, [], len(data)))

    def encode_word(self, word: str) -> bytes:
        ids = [i for m in self.pattern.findall(word) for i in self.encode_piece(m.encode("utf-8", "surrogatepass"))]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_word(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EditableEncoding:
    """One byte string with its prefix table: exact appends, and re-encoding near edits."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data = bpe, data
        self.last = bpe.extend(data, [], len(data))

    def append(self, more: bytes) -> EditableEncoding:
        self.data += more
        self.bpe.extend(self.data, self.last, len(self.data))
        return self

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop]; returns how many prefixes were solved again. After the edit a run of
        as many equal entries as the longest token has bytes means that all later ones are equal too."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same, solved = old[:start], 0, 0
        while len(self.last) < len(self.data):
            at = len(self.last)
            self.bpe.extend(self.data, self.last, at + 1)
            solved += 1
            same = same + 1 if at >= start + len(new) and self.last[at] == old[at - shift] else 0
            if same >= self.bpe.longest:
                self.last += old[at - shift + 1:]
                break
        return solved

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


_ENCODERS: dict[tuple[str, str], tuple[PrefixBPE, WordCache, WordCache]] = {}


def _encoder(rank_file: str, pattern: str):
    """One encoder and word cache a worker process."""
    if (rank_file, pattern) not in _ENCODERS:
        bpe = PrefixBPE(rank_file, pattern)
        _ENCODERS[rank_file, pattern] = (bpe, WordCache(lambda w: bpe.encode_word(" " + w)),
                                         WordCache(bpe.encode_word, FIRST_WORDS))
    return _ENCODERS[rank_file, pattern]


def _ends_in_space(word: str) -> bool:
    """Words after which the next space does not start a match of its own."""
    return not word or word[-1].isspace() or ord(word[-1]) < 33


def encode_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>) of every whole text."""

    def run(batches):
        bpe, cache, first = _encoder(rank_file, pattern)
        for b in slices(batches):
            ids, offsets = encode_texts(whole_texts(b), cache, first, _ends_in_space, bpe.encode_word)
            lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists.cast(pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(run, f"doc_id {_type(docs)}, ids array<int>")


def _type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, decoded (binary: the bytes of the ids)."""

    def run(batches):
        bpe = _encoder(rank_file, pattern)[0]
        for b in batches:
            out = [bpe.decode(x or ()) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.mapInArrow(run, f"doc_id {_type(encoded)}, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Digest of encoding and decoding every text: doc_id, n_tokens, ids_sha256, decoded_sha256. Ids stay in
    the task that made them; they are decoded from a table of token bytes by array operations."""

    def run(batches):
        bpe, cache, first = _encoder(rank_file, pattern)
        size = max(bpe.tokens) + 1
        lengths = np.zeros(size, np.int64)
        for r, t in bpe.tokens.items():
            lengths[r] = len(t)
        flat = np.frombuffer(b"".join(bpe.tokens.get(i, b"") for i in range(size)), np.uint8)
        begins = np.cumsum(lengths) - lengths
        for b in slices(batches):
            ids, offsets = encode_texts(whole_texts(b), cache, first, _ends_in_space, bpe.encode_word)
            raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
            byte_ends = np.concatenate(([0], np.cumsum(lengths[ids])))[offsets]
            sha_ids, sha_text = [], []
            step = 512
            for at in range(0, len(offsets) - 1, step):
                top = min(at + step, len(offsets) - 1)
                own = ids[offsets[at]:offsets[top]]
                n = lengths[own]
                ends = np.cumsum(n)
                where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins[own] - (ends - n), n)
                decoded = memoryview(flat[where].tobytes())
                for t in range(at, top):
                    sha_ids.append(hashlib.sha256(raw[4 * offsets[t]:4 * offsets[t + 1]]).hexdigest())
                    sha_text.append(hashlib.sha256(
                        decoded[byte_ends[t] - byte_ends[at]:byte_ends[t + 1] - byte_ends[at]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(sha_ids, pa.string()),
                 pa.array(sha_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(
        run, f"doc_id {_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
