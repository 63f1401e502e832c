"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For every prefix of a segment the table stores the one token that ends the
prefix's encoding.  It is found among the pieces that an Aho-Corasick automaton
reports as ending there, longest first: the first whose predecessor (the stored
token of the prefix before it) is *compatible*, i.e. the two side by side stay
two tokens.  The ids are recovered backwards from the last entry.

Text is cut where no piece of the vocabulary spans the cut (before a run of
word marks that follows another character, if no piece has a mark after another
character), so equal segments share one table within a worker.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reelframe.llm.common import per_worker, table

MARK = "▁"  # the word mark that stands for a space
MEMO_SEGMENTS = 300_000  # segments of a generation of the memo; two are kept per worker
MEMO_PAIRS = 400_000


class PrefixTableEncoder:
    """Encoder of one sentencepiece BPE model with byte fallback."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("a BPE model without normalisation is needed")
        self.prefix = bool(norm.add_dummy_prefix)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = self.processor.eos_id()
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        scores: list[float] = []
        for i, piece in enumerate(proto.pieces):
            scores.append(piece.score)
            if piece.type == 6:
                self.bytes[int(piece.piece[1:-1], 16)] = i
            elif piece.type == 1:
                self.ids[piece.piece] = i
            elif piece.type in (4, 5):
                raise ValueError("user-defined or unused pieces are not supported")
        self.unknown = self.processor.unk_id()
        self.size = len(scores)
        self.piece = [p.piece for p in proto.pieces]
        self.length = [len(p) for p in self.piece]
        self.score = scores
        # the last merge of each piece, and the place of that merge in the order of merges
        order = sorted(self.ids.values(), key=lambda i: -scores[i])
        tied = {i for i, j in zip(order, order[1:]) if scores[i] == scores[j]}
        tied |= {j for i, j in zip(order, order[1:]) if scores[i] == scores[j]}
        rank = {i: at for at, i in enumerate(order)}
        self.halves: dict[int, tuple[int, int]] = {}
        self.formed = [-1] * self.size
        self.auto = ahocorasick.Automaton()
        for text, i in self.ids.items():
            parts, last = self._merge(text)
            if parts != [text]:
                continue  # no text ever yields it
            self.auto.add_word(text, i)
            if last:
                self.halves[i] = last
                self.formed[i] = rank[i]
        self.auto.make_automaton()
        # pieces whose order of merging the ranks alone don't settle: tied scores, or
        # made of a piece that merges later than they do
        self.slow = set(tied)
        for i in order:
            if i in self.halves and any(self.formed[h] > self.formed[i] or h in self.slow for h in self.halves[i]):
                self.slow.add(i)
        # a cut before a mark is safe if no piece has a mark after another character
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.segment = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.decimal = [str(i) for i in range(self.size)]

    def _merge(self, text: str) -> tuple[list[str], tuple[int, int] | None]:
        """Merge the characters of a short string (at most two pieces long): best
        score first, leftmost on ties.  Also the halves of the last merge."""
        ids, score = self.ids, self.score
        parts, last = list(text), None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if at < 0:
                break
            last = ids.get(parts[at], -1), ids.get(parts[at + 1], -1)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay two tokens.

        The merges are undone from the last one backwards; at each step the two
        pieces that touch the boundary must not merge before the undone merge
        (nor at the same rank if they lie left of it).
        """
        ids, piece, formed = self.ids, self.piece, self.formed
        ends = [piece[left], piece[right]]
        if left in self.slow or right in self.slow:
            return self._merge("".join(ends))[0] == ends
        limit = self.size
        while True:
            whole = ids.get(piece[left] + piece[right])
            if whole is not None:
                if whole in self.slow:
                    return self._merge("".join(ends))[0] == ends
                if formed[whole] < limit:
                    return False
            if formed[left] > formed[right]:
                limit = formed[left]
                left = self.halves[left][1]
            elif formed[right] >= 0:
                limit = formed[right] + 1
                right = self.halves[right][0]
            else:
                return True

    def tokens(self, text: str) -> tuple[int, ...]:
        """Ids of a segment by the prefix table."""
        length, pairs, size = self.length, self.pairs, self.size
        # the last token of each prefix; -1: a character without a piece, which never merges
        table = [-1] * (len(text) + 1)
        done = -1
        for end, i in self.auto.iter(text):  # longest first at each end
            if end == done:
                continue
            before = end + 1 - length[i]
            left = table[before]
            if before and left >= 0:
                known = pairs.get(left * size + i)
                if known is None:
                    if len(pairs) >= MEMO_PAIRS:
                        pairs.clear()
                    known = pairs[left * size + i] = self.compatible(left, i)
                if not known:
                    continue
            table[end + 1] = i
            done = end
        out, at = [], len(text)
        while at:
            i = table[at]
            if i >= 0:
                out.append(i)
                at -= length[i]
            else:
                at -= 1
                out += self.fallback(text[at])
        out.reverse()
        return tuple(out)

    def fallback(self, char: str) -> list[int]:
        """Ids of a character without a piece, last first."""
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in reversed(char.encode("utf-8"))]

    def learn(self, text: str) -> tuple[int, ...]:
        """Ids of a segment, kept in a memo of two generations."""
        known = self.older.get(text)
        if known is None:
            known = self.tokens(text)
        if len(text) <= 64:
            if len(self.memo) >= MEMO_SEGMENTS:
                self.older, self.memo = self.memo, {}
            self.memo[text] = known
        return known

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, end id last."""
        ids: list[int] = []
        if text:
            marked = text.replace(" ", MARK)
            if self.prefix:
                marked = MARK + marked
            known = self.memo.get
            for part in self.segment.findall(marked) if self.cut else [marked]:
                found = known(part)
                if found is None:
                    found = self.learn(part)
                    known = self.memo.get
                ids += found
        ids.append(self.end)
        return ids

    def decimals(self, ids: list[int]) -> str:
        """The ids in decimal, joined by one space."""
        decimal = self.decimal
        return " ".join([decimal[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


def encoder_for(model: bytes) -> PrefixTableEncoder:
    return per_worker(f"encoder_{hashlib.sha256(model).hexdigest()}", lambda: PrefixTableEncoder(model))


def piece_model(path: str | None = None) -> bytes:
    """The model file's bytes (under 1 MB): shipped with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encode_texts(docs: DataFrame, model: bytes, keep_ids: bool = True, digests: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, plus ``ids`` (or only digests).

    A null text counts as empty; an empty text has the end id alone.  Rows are
    independent: no shuffle, repeated rows and ids are kept, and columns named
    like the results (n_tokens, ids, ids_sha256, decoded_sha256) are replaced.
    Each document is held once, however long.
    """
    new = [("n_tokens", "long")] + ([("ids", "array<int>")] if keep_ids else [])
    new += [("ids_sha256", "string"), ("decoded_sha256", "string")] if digests else []
    names = [n for n, _ in new]
    rest = [c for c in docs.columns if c != "text" and c not in names]
    frame = docs.select(*[docs[c] for c in rest], docs["text"])
    fields = [f for f in frame.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{n} {t}" for n, t in new])
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(shared.value)
        gc.disable()  # nothing here makes cycles; the collector would only walk the memo
        for batch in batches:
            part = cols = None
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, all_ids, ids_sha, text_sha = [], [], [], []
                for x in part.column(part.schema.get_field_index("text")):
                    ids = enc.encode(x.as_py() or "")
                    n.append(len(ids))
                    if keep_ids:
                        all_ids.append(ids)
                    if digests:
                        ids_sha.append(hashlib.sha256(enc.decimals(ids).encode()).hexdigest())
                        text_sha.append(hashlib.sha256(enc.decode(ids).encode("utf-8")).hexdigest())
                cols = [part.column(i) for i in range(part.num_columns - 1)]
                cols.append(pa.array(n, pa.int64()))
                if keep_ids:
                    cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                if digests:
                    cols += [pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields] + names)
            del batch, part, cols
            pa.default_memory_pool().release_unused()
        gc.enable()

    return frame.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, model: bytes, name: str = "text") -> DataFrame:
    """``encoded`` with the decoded text of its ``ids`` (null ids: empty text)."""
    rest = [f for f in encoded.schema.fields if f.name != name]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"`{name}` string"])
    frame = encoded.select(*[encoded[f.name] for f in rest])
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            texts = [enc.decode(x.as_py() or []) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])

    return frame.mapInArrow(run, schema)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, piece_model(), keep_ids=False, digests=True)
