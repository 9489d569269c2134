"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs whose join is a piece, ordered by the piece's score and then by place;
it takes the best pair, joins it, and adds the pairs that the join makes, until none is left. Symbols that are no piece fall
back to their bytes. No piece of the vocabulary joins a character to a following blank, or anything to a line feed, so
a text is cut there into chunks and each distinct chunk is encoded once. In every Arrow batch the chunks met for the first
time are checked against the library, whose ids hold if the two differ (``n_differ`` counts such chunks).
"""

from __future__ import annotations

import heapq
import re

from pyspark.sql import DataFrame, SparkSession

from .common import SLICE_BYTES, kept, slices, table, with_fields
from .idstore import IdStore

MAX_CHUNKS = 800_000
BLANK = "▁"
OUTPUT = ("n_tokens", "ids_sha256", "decoded_sha256", "n_differ")
# Texts that a split at every blank would not cut into chunks
IRREGULAR = f"  | \n|^[ \n]| $|{BLANK}"
CHUNK = re.compile(f"\n[^{BLANK}\n]*|{BLANK}*[^{BLANK}\n]+|{BLANK}+")


def piece_encoder(path: str | None = None) -> "PieceEncoder":
    """The encoder of this Python worker; ``path`` None is the 32k vocabulary of ``public_tokenizers``."""
    return kept(("pieces", path), lambda: PieceEncoder(path))


class PieceEncoder:
    def __init__(self, path: str | None = None, max_chunks: int = MAX_CHUNKS):
        import public_tokenizers
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.max_chunks = max_chunks
        n = lib.get_piece_size()
        self.id = {lib.id_to_piece(k): k for k in range(n) if not (lib.is_byte(k) or lib.is_control(k) or lib.is_unknown(k))}
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.id):
            raise ValueError("a piece joins a character to a blank, or has a line feed")
        self.order = {p: -lib.get_score(k) for p, k in self.id.items()}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._reset()

    def _reset(self):
        import numpy as np

        self.store, self.joined, self.differ = IdStore(), [""], np.zeros(1 << 16, bool)
        self.store.add([""], [[]])

    def merge(self, chunk: str) -> list[str]:
        """The pieces of a chunk, its blanks already escaped."""
        symbols, order = list(chunk), self.order
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda = [(order[pair], k, pair) for k, pair in enumerate(map(str.__add__, symbols, symbols[1:])) if pair in order]
        heapq.heapify(agenda)
        while agenda:
            _, left, pair = heapq.heappop(agenda)
            right = after[left]
            if right == len(symbols) or not symbols[left] or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been joined to another symbol
            symbols[left], symbols[right] = pair, ""
            follow = after[left] = after[right]
            if follow < len(symbols):
                before[follow] = left
                if (new := pair + symbols[follow]) in order:
                    heapq.heappush(agenda, (order[new], left, new))
            if (lead := before[left]) >= 0 and (new := symbols[lead] + pair) in order:
                heapq.heappush(agenda, (order[new], lead, new))
        return [s for s in symbols if s]

    def ids(self, chunk: str) -> list[int]:
        out = []
        for piece in self.merge(chunk):
            k = self.id.get(piece)
            if k is None:
                out += [self.byte[b] for b in piece.encode()]
            else:
                out.append(k)
        return out

    def _learn(self, keys: list[str]):
        # a key is a chunk, but for the blank before a chunk without further ones
        escaped = [k if k[0] == "\n" or BLANK in k else BLANK + k for k in keys]
        mine = [self.ids(c) for c in escaped]
        # the library puts a blank before each text; a chunk that begins with a line feed has none
        theirs = self.library.encode([c if c[0] == "\n" else c[1:].replace(BLANK, " ") for c in escaped], num_threads=1)
        # (but an empty text has no ids, so the library can't be asked about a lone blank)
        theirs = [m if c == BLANK else t[1:] if c[0] == "\n" else t for m, t, c in zip(mine, theirs, escaped)]
        first = len(self.joined)
        # the agenda's ids; where the library has others, which ``n_differ`` counts, its ids hold
        ids = [m if m == t else t for m, t in zip(mine, theirs)]
        self.store.add(keys, ids)
        self.joined += [",".join(map(str, i)) for i in ids]
        self.differ = self.store._room(self.differ, len(self.joined))
        for k, (m, t) in enumerate(zip(mine, theirs), first):
            self.differ[k] = m != t

    def encode(self, texts):
        """(numbers of all chunks in a row, the end of each text in them) for an Arrow string array; a null is empty."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.joined) > self.max_chunks:
            self._reset()
        texts = texts.fill_null("")
        odd = np.flatnonzero(pc.match_substring_regex(texts, IRREGULAR).to_numpy(zero_copy_only=False))
        regular = pc.if_else(pc.match_substring_regex(texts, IRREGULAR), "", texts) if len(odd) else texts
        lists = pc.split_pattern(pc.replace_substring(regular, "\n", " \n"), " ")
        until = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values[until[0]:until[-1]].dictionary_encode()
        until -= until[0]
        words = np.array(self.store.numbers(coded.dictionary.to_pylist(), self._learn), np.int64)
        numbers = words[coded.indices.to_numpy(zero_copy_only=False)]
        if not len(odd):
            return numbers, until[1:]
        parts = [numbers[a:b] for a, b in zip(until, until[1:])]
        for k in odd.tolist():
            chunks = CHUNK.findall(BLANK + texts[k].as_py().replace(" ", BLANK))
            parts[k] = np.array(self.store.numbers(chunks, self._learn_distinct), np.int64)
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def _learn_distinct(self, keys):
        self._learn(list(dict.fromkeys(keys)))


def encode(docs: DataFrame, model: str | None = None, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (the decoded ids), n_differ, and
    ``ids`` and ``decoded`` if asked for.

    Whole texts are encoded as the library does without begin or end ids and without sampling, then decoded by it. A null
    text is empty and has no ids. Columns of ``docs`` with the names of the result are replaced; repeated rows are
    encoded alike; an empty table gives an empty result.
    """
    def body(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        def sha(text):
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in slices(batches, text_col, 2 * SLICE_BYTES):
            encoder = piece_encoder(model)
            column = batch.column(batch.schema.get_field_index(text_col))
            numbers, until = encoder.encode(column)
            ids, after = encoder.store.gather(numbers)
            cuts = np.concatenate(([0], after))[np.concatenate(([0], until))].tolist()  # by text, in ids
            joined, begin, shas = encoder.joined, 0, []
            for end in until.tolist():
                shas.append(sha(",".join([joined[k] for k in numbers[begin:end].tolist()])))
                begin = end
            decoded = [encoder.library.decode(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
            differ = np.add.reduceat(np.append(encoder.differ[numbers], False), np.concatenate(([0], until[:-1])), dtype=np.int64)
            differ[np.diff(until, prepend=0) == 0] = 0
            columns = [pa.array(np.diff(cuts)), pa.array(shas), pa.array([sha(d) for d in decoded]), pa.array(differ)]
            names = list(OUTPUT)
            if with_ids:
                columns += [pa.ListArray.from_arrays(np.array(cuts, np.int32), ids.astype(np.int32)), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    extra = (("ids", "array<int>"), ("decoded", "string")) if with_ids else ()
    docs = docs.drop(*OUTPUT, *(name for name, _ in extra))
    fields = (("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string"), ("n_differ", "bigint"), *extra)
    return docs.mapInArrow(body, with_fields(docs.schema, *fields))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
