"""Packing documents into token sequences: bounded-space online best fit for each partition, leftovers merged."""

from __future__ import annotations

import bisect
import itertools
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import batched, checkpoint, portions, release

#: Words that a Python worker remembers with their ids, and the longest that it remembers.
MEMO_WORDS, MEMO_STEMS, MEMO_CHARS = 600_000, 200_000, 64
CHUNK = 256
#: The pattern of words of a tokenizer that keeps letters together.
LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Closing marks that are cut from words.
MARKS = b".,;:!?#%$*&|)"
#: Partitions whose leftovers one task merges.
FAN_IN = 32

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _is_plain(spec: dict) -> bool:
    """Whether a word of small ASCII letters alone reaches the model of a tokenizer as it is and in one piece, and nothing is added behind."""
    steps = [x for x in ((spec.get(k) or {}) for k in ("normalizer", "pre_tokenizer"))]
    norms, cuts = ([x] if x and x.get("type") != "Sequence" else x.get("normalizers") or x.get("pretokenizers") or [] for x in steps)
    blank = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    return (
        all(x == blank or x["type"] in ("NFC", "Lowercase") for x in norms)
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"].get("Regex") == LETTERS and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and not spec.get("post_processor") and not spec["model"].get("dropout")
        and not any(x["content"].isalpha() for x in spec["added_tokens"])
    )


def _older(memo: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """The half that was learnt first: frequent words come early, so most of those that come again stay."""
    return dict(itertools.islice(memo.items(), len(memo) // 2))


class WordTokenizer:
    """Token ids (little-endian uint32) of texts, by a tokenizer that drops white space.

    No token spans ASCII white space, so the words between are encoded once and remembered. Strings of special tokens in a
    text are those tokens, as the tokenizer has it by default.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        self.direct = _is_plain(parts)
        end = parts["model"].get("end_of_word_suffix") or "\0"
        self.closes = np.zeros(max(self.model.get_vocab().values()) + 1, bool)
        self.closes[[i for t, i in self.model.get_vocab().items() if t.endswith(end)]] = True
        self.memo: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {b"": b""}

    def _ids(self, parts: list[bytes]) -> None:
        """Learn the ids of parts. Those of letters alone are one word each, so many are encoded as one text and told apart by
        the tokens that end a word; where only the model changes small ASCII letters, it is asked itself."""
        if self.direct:
            small = [p for p in parts if p.isascii() and p.isalpha() and p.islower()]
            if small:
                split, ids, stops = self.model.model.tokenize, [], []
                for w in b" ".join(small).decode().split(" "):
                    ids += [x.id for x in split(w)]
                    stops.append(4 * len(ids))
                raw = np.array(ids, "<u4").tobytes()
                self.stems.update((p, raw[x:y]) for p, x, y in zip(small, [0, *stops], stops))
                parts = list(set(parts).difference(small))
        plain = [p for p in parts if p.isalpha() or not p.isascii() and p.decode().isalpha()]
        if plain:
            ids = np.array(self.model.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) == len(plain):
                raw, stops = ids.tobytes(), ends.tolist()
                self.stems.update((p, raw[x:y]) for p, x, y in zip(plain, [0, *stops], stops))
                parts = list(set(parts).difference(plain))
        for p, x in zip(parts, self.model.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)):
            self.stems[p] = np.array(x.ids, "<u4").tobytes()

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, each cut into a stem and closing marks, where a cut between tokens is sure.

        The tokenizer cuts between a letter or digit and marks that follow, none of which is an apostrophe here. Only ASCII and
        Latin-1 letters count: others may end in a combining mark in lower case.
        """
        cut = []
        for w in new:
            s = w.rstrip(MARKS)
            sure = len(s) < len(w) and (s[-1:].isalnum() or len(s) > 1 and s[-2] == 0xC3 and s[-1] not in (0x97, 0xB7))
            cut.append(s if sure else w)
        if len(self.stems) > MEMO_STEMS:
            self.stems = _older(self.stems)
        stems = self.stems
        need = set(cut)
        need.update(w[len(s) :] for w, s in zip(new, cut) if len(s) < len(w))
        need.difference_update(stems)
        self._ids(list(need))
        learnt = {w: stems[s] if len(s) == len(w) else stems[s] + stems[w[len(s) :]] for w, s in zip(new, cut)}
        for p in need:
            if len(p) > MEMO_CHARS:
                del stems[p]
        return learnt

    @staticmethod
    def _words(text: bytes) -> list[bytes]:
        """Words, A-Z as small letters, which the tokenizer does as well; but it composes a capital with a mark that follows
        and looks for special tokens before that, so texts with combining marks or ``<|`` stay as they are."""
        return (text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()).split()

    def encode(self, texts: list[str]) -> list[bytes]:
        lists = [self._words(t.encode()) for t in texts]
        memo = self.memo
        new = list(set().union(*lists).difference(memo))
        if new:
            memo.update(self._learn(new))
        out = [b"".join(map(memo.__getitem__, ws)) for ws in lists]
        for w in new:
            if len(w) > MEMO_CHARS:
                memo.pop(w, None)
        if len(memo) > MEMO_WORDS:
            self.memo = _older(memo)
        return out


_tokenizer: list = ["", None]


def _get(shared) -> WordTokenizer:
    """The tokenizer of this worker, which keeps it from one task to the next."""
    if _tokenizer[0] != shared.value:
        _tokenizer[:] = shared.value, WordTokenizer(shared.value)
    return _tokenizer[1]


class Packer:
    """Bounded-space best fit: at most ``open_windows`` windows are open at any time.

    A piece goes to the window where it leaves the least room. Where none fits, the fullest window is emitted;
    before that, the head of the piece fills it up if at least ``min_cut`` tokens fit on both sides of the cut.
    """

    def __init__(self, size: int, open_windows: int, min_cut: int):
        self.size, self.limit, self.min_cut = size, open_windows, min_cut
        self.room: list[tuple[int, int]] = []  # (free tokens, window), ascending
        self.windows: dict[int, list[tuple]] = {}
        self.made = 0
        self.closed: list[tuple[int, list[tuple]]] = []

    def _close(self, window: int) -> None:
        self.closed.append((window, self.windows.pop(window)))

    def _put(self, window: int, free: int, piece: tuple) -> None:
        self.windows[window].append(piece)
        free -= piece[2]
        if free:
            bisect.insort(self.room, (free, window))
        else:
            self._close(window)

    def _cut(self, piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, start, length, total, ids = piece
        return (doc, start, n, total, ids[: 4 * n]), (doc, start + n, length - n, total, ids[4 * n :])

    def add(self, piece: tuple) -> None:
        """piece: (doc_id, start, length, doc_tokens, ids)."""
        while piece[2] > self.size:
            head, piece = self._cut(piece, self.size)
            self.made += 1
            self.closed.append((self.made, [head]))
        at = bisect.bisect_left(self.room, (piece[2], -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
            return self._put(window, free, piece)
        if len(self.room) == self.limit:
            free, window = self.room.pop(0)  # the fullest
            if self.min_cut <= free <= piece[2] - self.min_cut:
                head, piece = self._cut(piece, free)
                self._put(window, free, head)
            else:
                self._close(window)
        self.made += 1
        self.windows[self.made] = []
        self._put(self.made, self.size, piece)

    def drain(self) -> list[tuple]:
        done, self.closed = self.closed, []
        return done

    def leftovers(self) -> list[tuple]:
        return [(w, self.windows[w]) for _, w in self.room]


def _rows(done: list, base: int, is_open: bool, with_ids: bool, ids_too: bool) -> list[tuple]:
    out = []
    for window, pieces in done:
        offset = 0
        for doc, start, length, total, ids in pieces:
            out.append((doc, start, length, zlib.crc32(ids), total, base + window, offset, is_open, ids if with_ids or is_open and ids_too else None))
            offset += length
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", "ids"]
    df = pd.DataFrame(rows, columns=names)
    return df.astype({"doc_id": "Int64"} | {n: "int64" for n in names[1:7]})


def pack(
    df: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 16,
    min_cut: int = 8,
    with_ids: bool = False,
    text: str = "text",
) -> DataFrame:
    """Pack the tokens of all texts, each with ``end_id`` at its end, into sequences of ``size`` tokens at most.

    tokenizer: the JSON of a tokenizer that drops white space. One row for each piece of a document; with
    ``with_ids`` also its ids (binary, little-endian uint32). A null or empty text is its end id alone; a null
    doc_id stays null. Each partition packs online with ``open_windows`` open windows. What they hold at the end,
    bounded for each partition, is merged in rounds: one task packs the leftovers of FAN_IN partitions in
    the same way, until one partition's leftovers remain, which are the last sequences.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    schema = PIECES + ", open boolean, ids binary, part long"
    docs = df.select("doc_id", F.col(text).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packer, coder = Packer(size, open_windows, min_cut), _get(shared)
        for whole in batches:
            for k, stop in portions(whole["text"].str.len().fillna(0).to_numpy(), CHUNK):
                batch = whole.iloc[k:stop]
                texts = [t if isinstance(t, str) else "" for t in batch["text"]]
                for doc, ids in zip(batch["doc_id"].tolist(), coder.encode(texts)):
                    ids += end
                    packer.add((None if pd.isna(doc) else int(doc), 0, len(ids) // 4, len(ids) // 4, ids))
                yield _frame(_rows(packer.drain(), part << 24, False, with_ids, True)).assign(part=part)
        yield _frame(_rows(packer.leftovers(), part << 24, True, with_ids, True)).assign(part=part)
        release()  # the words learnt stay for the worker's next task

    def again(level: int, last: bool) -> Callable:
        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            group = int(pdf["group"].iloc[0])
            pdf = pdf.sort_values(["part", "sequence_id", "offset"])
            packer = Packer(size, open_windows, 1 if last else min_cut)
            for doc, start, length, total, ids in zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["doc_tokens"], pdf["ids"]):
                packer.add((None if pd.isna(doc) else int(doc), int(start), int(length), int(total), bytes(ids)))
            base = (level << 56) + (group << 24)
            rows = _rows(packer.drain(), base, False, with_ids, True)
            rest = packer.leftovers()
            if last:  # fill one window after the other, so that at most one stays short
                final = Packer(size, 1, 1)
                final.made = packer.made
                for _, pieces in rest:
                    for piece in pieces:
                        final.add(piece)
                rows += _rows(final.drain() + final.leftovers(), base, False, with_ids, True)
            else:
                rows += _rows(rest, base, True, with_ids, True)
            return _frame(rows).assign(part=group)

        return merge

    made = checkpoint(batched(docs).mapInPandas(first, schema))
    done, left = [made.where("not open")], made.where("open")
    parts = (made.agg(F.max("part")).first()[0] or 0) + 1
    level = 0
    while True:
        level += 1
        last = parts <= FAN_IN
        grouped = left.withColumn("group", F.expr(f"part div {FAN_IN}")).groupBy("group")
        made = checkpoint(grouped.applyInPandas(again(level, last), schema))
        done.append(made.where("not open"))
        if last:
            break
        left, parts = made.where("open"), -(-parts // FAN_IN)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open", "part") if with_ids else out.drop("open", "part", "ids")
