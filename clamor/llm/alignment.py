"""Alignment of the tokens of two tokenizers over the same bytes.

Both token sequences of a text are sequences of byte ranges.  Where tokens of both end
at the same byte, a group of tokens closes; a link is a pair of tokens, one of each
tokenizer, whose ranges overlap.  A link is worth the number of links in the whole corpus
that hold its pair of ids.

* **Fragments.**  A byte range of a document gives a fragment: the tokens up to the first
  common end (an open head), the closed groups behind it, and the tokens after the last
  one (an open tail).  Two neighbours compose: the tail of one and the head of the next
  close one group.  Composition is associative, and a range without a common end is a
  head alone.  An ordinary document is one fragment.  A long one is encoded in segments
  by many tasks, gives a fragment for each byte range, and a tree of groupings of bounded
  width composes them.
* **Segments.**  A long text is cut before single blanks between other characters.  Both
  encodings break there by themselves: no match of the pattern runs into a blank, and no
  piece of the second vocabulary holds a blank after another character (checked when it
  is loaded).
* **Counts.**  Pairs are added up in each task, then by one aggregate.  The most frequent
  ones, at most HOT, are broadcast, so that most links are valued where they lie; only
  the pairs of rarer links are shuffled, each of which occurs less often than every hot
  one, so no key of that join is hot.

Both encoders are byte ranks.  The second vocabulary merges characters, so the bytes of
its characters merge first, and characters that it lacks stay bytes.

Texts that are null, empty or hold U+2581, which the second tokenizer gives back as a
blank, have no tokens: zeros and an empty digest.  Null and repeated ids and repeated
rows are rows like any others.  An empty table gives an empty result.  Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import text_or_empty, work_folder
from clamor.llm.word_tokens import _byte_letters

LONG = 1 << 16  # bytes of a text that is still one fragment, and of a segment
RANGE = 1 << 14  # bytes of a fragment of a longer one
FAN = 16  # ranges that a node of the tree composes
HOT = 1 << 18  # pairs that are broadcast at most
HELD = 1 << 21  # distinct pairs that a task adds up before it sends them
BLANK = "▁"

_TWO_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Encoders:
    """Both vocabularies as byte ranks."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path_a)
        byte_of = {chr(letter): b for b, letter in _byte_letters().items()}
        added = {t.content for t in library.get_added_tokens_decoder().values()}
        vocabulary = {
            bytes(byte_of[c] for c in token): k
            for token, k in library.get_vocab(with_added_tokens=False).items()
            if token not in added
        }
        self.n_a = max(vocabulary.values()) + 1
        self.length_a = np.zeros(self.n_a, np.int64)
        for token, k in vocabulary.items():
            self.length_a[k] = len(token)
        self.whole = _ranks(pattern, vocabulary)
        # Without two blanks in a row the lookahead of the pattern decides nothing.
        self.plain = _ranks(pattern.replace(r"\s+(?!\S)|\s+", r"\s"), vocabulary)

        pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.n_b = pieces.get_piece_size()
        self.length_b = np.zeros(self.n_b, np.int64)
        fallback, characters, longer = {}, {}, []
        for k in range(self.n_b):
            name = pieces.id_to_piece(k)
            if pieces.is_byte(k):
                fallback[int(name[1:-1], 16)], self.length_b[k] = k, 1
            elif not pieces.is_control(k) and not pieces.is_unknown(k):
                shown = name.replace(BLANK, " ")
                if re.search("[^ ] ", shown):
                    raise ValueError("a piece holds a blank after another character")
                self.length_b[k] = len(shown.encode())
                if len(shown) == 1:
                    characters[shown.encode()] = k
                else:
                    longer.append((-pieces.get_score(k), k, shown.encode()))
        meaning = {bytes([b]): [characters.get(bytes([b]), fallback[b])] for b in range(256)}
        for size in (2, 3, 4):  # the first bytes of each character, then all of it
            for c in characters:
                if len(c) >= size and c[:size] not in meaning:
                    meaning[c[:size]] = [fallback[b] for b in c[:size]]
                if len(c) == size:
                    meaning[c] = [characters[c]]
        meaning |= {token: [k] for _, k, token in sorted(longer)}
        self.pieces = _ranks(" *[^ ]+| +", {token: k for k, token in enumerate(meaning)})
        self.ids = np.array([k for ids in meaning.values() for k in ids], np.int64)
        self.ids_of = np.array([len(ids) for ids in meaning.values()], np.int64)
        self.ids_at = np.cumsum(self.ids_of) - self.ids_of

        shown = [b"%d," % k for k in range(self.n_a)] + [b"%d|" % k for k in range(self.n_a)]
        shown += [b"%d," % k for k in range(self.n_b)] + [b"%d;" % k for k in range(self.n_b)]
        self.shown = shown.__getitem__

    def first(self, text: str) -> np.ndarray:
        ranks = self.whole if _TWO_BLANKS.search(text) else self.plain
        return np.array(ranks.encode_ordinary(text), np.int64)

    def second(self, text: str) -> np.ndarray:
        ranks = np.array(self.pieces.encode_ordinary(text), np.int64)
        counts = self.ids_of[ranks]
        if not (counts > 1).any():
            return self.ids[self.ids_at[ranks]]
        at = np.repeat(self.ids_at[ranks] - (np.cumsum(counts) - counts), counts)
        return self.ids[at + np.arange(len(at))]

    def both(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a blank and the text by both; None where they have no tokens."""
        if not text or BLANK in text:
            return None
        text = " " + text
        a, b, size = self.first(text), self.second(text), len(text.encode())
        same = self.length_a[a].sum() == size == self.length_b[b].sum()
        return (a, b) if same else None


def _ranks(pattern: str, tokens: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tokens, special_tokens={})


@lru_cache(maxsize=2)
def encoders(path_a: str, pattern: str, path_b: str) -> Encoders:
    return Encoders(path_a, pattern, path_b)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, whether one of the other sequence ends with it."""
    at = np.searchsorted(ends_b, ends_a)
    cut_a = np.zeros(len(ends_a), bool)
    inside = at < len(ends_b)
    cut_a[inside] = ends_b[at[inside]] == ends_a[inside]
    cut_b = np.zeros(len(ends_b), bool)
    cut_b[at[cut_a]] = True
    return cut_a, cut_b


def links(enc: Encoders, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, code of the pair) of each link of two sequences over the same bytes.

    Between two neighbouring ends lies one token of each, so each end is one link.
    """
    ends_a, ends_b = np.cumsum(enc.length_a[a]), np.cumsum(enc.length_b[b])
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    return ends, a[np.searchsorted(ends_a, ends)] * enc.n_b + b[np.searchsorted(ends_b, ends)]


def group_codes(
    enc: Encoders, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray
) -> np.ndarray:
    """Places in the table of shown ids, in the order in which closed groups are written."""
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    # Tokens of the other sequence up to and with each group.
    upto_a = np.append(0, np.flatnonzero(cut_a) + 1)
    upto_b = np.append(0, np.flatnonzero(cut_b) + 1)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + upto_b[group_a]] = a + cut_a * enc.n_a
    codes[np.arange(len(b)) + upto_a[group_b + 1]] = 2 * enc.n_a + b + cut_b * enc.n_b
    return codes


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes.astype(np.uint32), return_counts=True)


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by code of several such pairs of arrays."""
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    sums = np.zeros(len(codes), np.int64)
    np.add.at(sums, place, np.concatenate([n for _, n in parts]))
    return codes, sums


class Fragment(NamedTuple):
    """Tokens of a byte range; ids as arrays, groups as they are shown, links as counts.

    ``cut`` tells whether the range has a common end; without one all is head.
    """

    cut: bool
    head_a: np.ndarray
    head_b: np.ndarray
    body: bytes
    n_groups: int
    n_links: int
    codes: np.ndarray
    counts: np.ndarray
    tail_a: np.ndarray
    tail_b: np.ndarray


_NO_IDS = np.zeros(0, np.int64)


def closed(enc: Encoders, a: np.ndarray, b: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """(groups as they are shown, their number, codes of their links) of tokens that begin
    and end at common ends."""
    cut_a, cut_b = common_ends(np.cumsum(enc.length_a[a]), np.cumsum(enc.length_b[b]))
    shown = b"".join(map(enc.shown, group_codes(enc, a, b, cut_a, cut_b).tolist()))
    return shown, int(cut_a.sum()), links(enc, a, b)[1]


def fragment(
    enc: Encoders, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray
) -> Fragment:
    """Fragment of tokens with their last bytes, whatever came before them."""
    cut_a, cut_b = common_ends(ends_a, ends_b)
    if not cut_a.any():
        empty = counted(_NO_IDS)
        return Fragment(False, a, b, b"", 0, 0, *empty, _NO_IDS, _NO_IDS)
    (at_a, to_a), (at_b, to_b) = (np.flatnonzero(c)[[0, -1]] + 1 for c in (cut_a, cut_b))
    body, n_groups, codes = closed(enc, a[at_a:to_a], b[at_b:to_b])
    return Fragment(
        True, a[:at_a], b[:at_b], body, n_groups, len(codes), *counted(codes), a[to_a:], b[to_b:]
    )


def compose(enc: Encoders, parts: list[Fragment]) -> Fragment:
    """One fragment of neighbours, in their order; all seams are closed together."""
    cuts = [k for k, p in enumerate(parts) if p.cut]
    if not cuts:
        a, b = (np.concatenate([getattr(p, side) for p in parts]) for side in ("head_a", "head_b"))
        return parts[0]._replace(head_a=a, head_b=b)

    def tokens(side: str, of: list[np.ndarray], upto: list[Fragment]) -> np.ndarray:
        return np.concatenate([*of, *[getattr(p, f"head_{side}") for p in upto]])

    first = cuts[0]
    head = [tokens(s, [], parts[: first + 1]) for s in "ab"]
    body, n_groups, n_links, sums = [], 0, 0, []
    for here, after in zip(cuts, [*cuts[1:], None], strict=True):
        p = parts[here]
        body.append(p.body)
        n_groups, n_links = n_groups + p.n_groups, n_links + p.n_links
        sums.append((p.codes, p.counts))
        behind = parts[here + 1 : None if after is None else after + 1]
        tail = [tokens(s, [getattr(p, f"tail_{s}")], behind) for s in "ab"]
        if after is not None:
            shown, groups, codes = closed(enc, *tail)
            body.append(shown)
            n_groups, n_links = n_groups + groups, n_links + len(codes)
            sums.append(counted(codes))
    return Fragment(True, *head, b"".join(body), n_groups, n_links, *added(sums), *tail)


def finished(enc: Encoders, root: Fragment) -> tuple[bytes, int, int, np.ndarray, np.ndarray]:
    """(groups, their number, links, codes, counts) of a whole document, whose begin is a
    common end."""
    shown, groups, codes = closed(enc, root.head_a, root.head_b)
    sums = added([counted(codes), (root.codes, root.counts)])
    return shown + root.body, groups + root.n_groups, len(codes) + root.n_links, *sums


# --------------------------------------------------------------------------
# Ordinary documents
# --------------------------------------------------------------------------

# A document with its ids, or with its links as codes and counts; or, without a row
# number, links that a task has added up.
_ROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("ids_a", pa.binary()), ("ids_b", pa.binary()),
    ("codes", pa.binary()), ("counts", pa.binary()),
])
_ROW_DDL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, ids_a binary, ids_b binary, codes binary, counts binary"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _digest(shown: bytes) -> str:
    return hashlib.sha256(shown[:-1]).hexdigest()


def _short(names: tuple[str, str, str]):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, number, sums = encoders(*names), TaskContext.get().partitionId() << 40, []
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            found, rows = [enc.both(t) for t in texts], []
            held = [f for f in found if f is not None]
            # All texts of a batch are one sequence: they end at common ends.
            if held:
                a, b = (np.concatenate([f[k] for f in held]) for k in (0, 1))
                ends_a, ends_b = np.cumsum(enc.length_a[a]), np.cumsum(enc.length_b[b])
                cut_a, cut_b = common_ends(ends_a, ends_b)
                shown = group_codes(enc, a, b, cut_a, cut_b)
                groups = np.append(0, np.cumsum(cut_a))
                sums.append(counted(links(enc, a, b)[1]))
            at_a = at_b = 0
            for key, ids in zip(keys, found, strict=True):
                if ids is None:
                    rows.append((number, key, 0, 0, 0, 0, "", b"", b"", None, None))
                else:
                    n_a, n_b = len(ids[0]), len(ids[1])
                    to_a, to_b = at_a + n_a, at_b + n_b
                    n = int(groups[to_a] - groups[at_a])
                    text = b"".join(map(enc.shown, shown[at_a + at_b : to_a + to_b].tolist()))
                    packed = [x.astype("<u2").tobytes() for x in ids]
                    rows.append((number, key, n_a, n_b, n, n_a + n_b - n, _digest(text), *packed, None, None))
                    at_a, at_b = to_a, to_b
                number += 1
            yield _batch(rows, _ROW)
            if sum(len(c) for c, _ in sums) > HELD:
                sums = [added(sums)]
                if len(sums[0][0]) > HELD // 2:
                    yield _sums(sums)
                    sums = []
        yield _sums(sums)

    return aligned


def _sums(sums: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    codes, counts = added(sums)
    return _batch([(*[None] * 9, codes.astype("<u4").tobytes(), counts.astype("<i8").tobytes())], _ROW)


# --------------------------------------------------------------------------
# Long documents
# --------------------------------------------------------------------------

_SEGMENT = pa.schema([
    ("row", pa.int64()), ("part", pa.int64()), ("base", pa.int64()), ("text", pa.string()),
])
_FRAGMENT = pa.schema([
    ("row", pa.int64()), ("node", pa.int64()), ("part", pa.int64()), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("fine", pa.bool_()), ("cut", pa.bool_()), ("head_a", pa.binary()),
    ("head_b", pa.binary()), ("body", pa.binary()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary()),
    ("tail_a", pa.binary()), ("tail_b", pa.binary()),
])
_KINDS = {"codes": "<u4", "counts": "<i8"} | {f"{k}_{s}": "<u2" for k in ("head", "tail") for s in "ab"}


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _segments(size: int):
    """Texts cut at the first fitting blank after each so many characters; the blank goes,
    as both encoders put one in front."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                text, low, base, part = r["text"], 0, 0, 0
                while low <= len(text):
                    blank = _CUT.search(text, low + size)
                    high = blank.start() if blank else len(text)
                    held = text[low:high]
                    yield _batch([(r["row"], part, base, held)], _SEGMENT)
                    low, base, part = high + 1, base + len(held.encode()) + 1, part + 1

    return cut


def _packed(fragment: Fragment) -> list:
    values = fragment._asdict()
    return [
        values[f].astype(_KINDS[f]).tobytes() if f in _KINDS else values[f] for f in Fragment._fields
    ]


def _unpacked(row: dict) -> Fragment:
    return Fragment(*[
        np.frombuffer(row[f], _KINDS[f]).astype(np.int64 if _KINDS[f] == "<u2" else _KINDS[f])
        if f in _KINDS else row[f]
        for f in Fragment._fields
    ])


def _fragments(names: tuple[str, str, str], span: int):
    """A fragment for each byte range that a segment has a part of."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(*names)
        for batch in batches:
            for r in batch.to_pylist():
                found = enc.both(r["text"])
                a, b = found or (_NO_IDS, _NO_IDS)
                ends_a = r["base"] + np.cumsum(enc.length_a[a])
                ends_b = r["base"] + np.cumsum(enc.length_b[b])
                node_a, node_b = (ends_a - 1) // span, (ends_b - 1) // span
                rows = []
                for node in np.union1d(node_a, node_b).tolist() or [r["base"] // span]:
                    (p, q), (s, t) = (np.searchsorted(x, [node, node + 1]) for x in (node_a, node_b))
                    piece = fragment(enc, a[p:q], b[s:t], ends_a[p:q], ends_b[s:t])
                    rows.append((
                        r["row"], node, r["part"], int(q - p), int(t - s), found is not None,
                        *_packed(piece),
                    ))
                yield _batch(rows, _FRAGMENT)

    return made


def _composed(names: tuple[str, str, str], fan: int):
    """One fragment of those of a node, a level up."""

    def of_node(table: pa.Table) -> pa.Table:
        enc = encoders(*names)
        rows = sorted(table.to_pylist(), key=lambda r: (r["node"], r["part"]))
        root = compose(enc, [_unpacked(r) for r in rows])
        first = rows[0]
        row = (
            first["row"], first["node"] // fan, first["part"], sum(r["n_a"] for r in rows),
            sum(r["n_b"] for r in rows), all(r["fine"] for r in rows), *_packed(root),
        )
        return pa.Table.from_batches([_batch([row], _FRAGMENT)])

    return of_node


def _roots(names: tuple[str, str, str]):
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(*names)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if not r["fine"]:
                    rows.append((r["row"], r["doc_id"], 0, 0, 0, 0, "", b"", b"", None, None))
                    continue
                shown, groups, n_links, codes, counts = finished(enc, _unpacked(r))
                rows.append((
                    r["row"], r["doc_id"], r["n_a"], r["n_b"], groups, n_links, _digest(shown),
                    None, None, codes.astype("<u4").tobytes(), counts.astype("<i8").tobytes(),
                ))
            yield _batch(rows, _ROW)

    return rows_of


def long_rows(
    texts: DataFrame, longest: int, names: tuple[str, str, str], size: int, span: int, fan: int
) -> DataFrame:
    """Rows of ``_ROW`` of a written table (row, doc_id, text) of long texts."""
    segments = texts.select("row", "text").mapInArrow(_segments(size), _ddl(_SEGMENT))
    # Segments of one document leave one task: deal them out before they are encoded.
    level = segments.repartition("row", "part").mapInArrow(_fragments(names, span), _ddl(_FRAGMENT))
    nodes = longest // span + 1
    while True:
        level = level.groupBy("row", F.floor(F.col("node") / fan).alias("up")).applyInArrow(
            _composed(names, fan), _ddl(_FRAGMENT)
        )
        nodes = -(-nodes // fan)
        if nodes == 1:
            break
    return level.join(texts.select("row", "doc_id"), "row").mapInArrow(_roots(names), _ROW_DDL)


# --------------------------------------------------------------------------
# Values of links
# --------------------------------------------------------------------------


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, code, n) of packed links."""
    for batch in batches:
        for r in batch.to_pylist():
            codes = np.frombuffer(r["codes"], "<u4").astype(np.int64)
            rows = np.full(len(codes), -1 if r["row"] is None else r["row"])
            yield pa.record_batch(
                [pa.array(rows), pa.array(codes), pa.array(np.frombuffer(r["counts"], "<i8"))],
                names=["row", "code", "n"],
            )


def least_hot_count(counts: DataFrame, most: int) -> int:
    """A power of two that at most ``most`` counts reach."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(power.alias("power")).count().collect()  # at most 63 rows
    held = 0
    for power, size in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        held += size
        if held > most:
            return 1 << (power + 1)
    return 1


def _valued(names: tuple[str, str, str], hot):
    """Documents with the worth of their hot links, and their other links."""

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(*names)
        codes, counts, best = (np.frombuffer(x, k) for x, k in zip(hot.value, ("<i8", "<i8", "?"), strict=True))
        for batch in batches:
            rows = batch.to_pylist()
            ids = [
                (np.frombuffer(r["ids_a"], "<u2"), np.frombuffer(r["ids_b"], "<u2"))
                for r in rows if r["ids_a"]
            ]
            owner, code, n = [], [], []
            if ids:
                a, b = (np.concatenate([x[k] for x in ids]).astype(np.int64) for k in (0, 1))
                ends, found = links(enc, a, b)
                size = np.cumsum([enc.length_a[x].sum() for x, _ in ids])
                number = np.array([k for k, r in enumerate(rows) if r["ids_a"]])
                owner.append(number[np.searchsorted(size, ends)])
                code.append(found)
                n.append(np.ones(len(found), np.int64))
            for k, r in enumerate(rows):
                if r["codes"]:
                    code.append(np.frombuffer(r["codes"], "<u4").astype(np.int64))
                    n.append(np.frombuffer(r["counts"], "<i8"))
                    owner.append(np.full(len(code[-1]), k))
            owner, code, n = (np.concatenate([_NO_IDS, *x]) for x in (owner, code, n))
            at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
            is_hot = codes[at] == code if len(codes) else np.zeros(len(code), bool)
            sums, bests = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            np.add.at(sums, owner[is_hot], counts[at[is_hot]] * n[is_hot])
            np.add.at(bests, owner[is_hot], best[at[is_hot]] * n[is_hot])
            cold = owner[~is_hot], code[~is_hot].astype(np.uint32), n[~is_hot]
            order = np.argsort(cold[0], kind="stable")
            edges = np.searchsorted(cold[0][order], np.arange(len(rows) + 1))
            packed = []
            for k in range(len(rows)):
                own = order[edges[k] : edges[k + 1]]
                rest = added([(cold[1][own], cold[2][own])])
                packed.append([rest[0].astype("<u4").tobytes(), rest[1].astype("<i8").tobytes()] if len(own) else [None, None])
            yield pa.record_batch(
                [batch.column(f) for f in _KEPT]
                + [pa.array(bests), pa.array(sums)]
                + [pa.array([p[k] for p in packed], pa.binary()) for k in (0, 1)],
                names=[*_KEPT, "n_best", "count_sum", "codes", "counts"],
            )

    return valued


_KEPT = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _written(df: DataFrame) -> DataFrame:
    """Like ``materialise``, with a codec that shortens packed ids."""
    path = work_folder(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(
    docs: DataFrame,
    path_a: str,
    pattern: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = LONG,
    span: int = RANGE,
    fan: int = FAN,
    most_hot: int = HOT,
) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best (links that no
    other link of their second id exceeds in count), count_sum, groups_sha256.

    ``path_a`` and ``pattern`` are a byte-level file and its pattern, ``path_b`` a piece
    model; both paths hold on every executor.  Texts of more than ``size`` bytes become
    fragments of ``span`` bytes, ``fan`` of which are composed at a time.
    """
    names, spark = (path_a, pattern, path_b), docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    short = _written(rows.where(F.octet_length("text") <= size).mapInArrow(_short(names), _ROW_DDL))
    held = _written(
        rows.where(F.octet_length("text") > size).select(
            (-1 - F.monotonically_increasing_id()).alias("row"), "doc_id", "text"
        )
    )
    longest = held.agg(F.max(F.octet_length("text"))).first()[0]
    found = short if longest is None else short.unionByName(
        _written(long_rows(held, longest + 1, names, size, span, fan))
    )
    packed = found.where(F.col("codes").isNotNull()).select("row", "codes", "counts")
    sums = (
        packed.mapInArrow(_pairs, "row long, code long, n long")
        .groupBy("code").agg(F.sum("n").alias("n"))
    )
    second = F.col("code") % F.lit(encoders(*names).n_b)
    sums = _written(sums.withColumn("b", second))
    most = sums.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of a vocabulary
    counts = sums.join(F.broadcast(most), "b").select(
        "code", "n", (F.col("n") == F.col("most")).alias("best")
    )
    least = least_hot_count(sums, most_hot)
    table = counts.where(F.col("n") >= least).toArrow().sort_by("code")
    hot = spark.sparkContext.broadcast([
        table.column(f).to_numpy().astype(k).tobytes()
        for f, k in (("code", "<i8"), ("n", "<i8"), ("best", "?"))
    ])
    shape = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, n_best long, count_sum long, codes binary, counts binary"
    )
    valued = _written(found.where(F.col("row").isNotNull()).mapInArrow(_valued(names, hot), shape))
    cold = (
        valued.where(F.col("codes").isNotNull())
        .select("row", "codes", "counts")
        .mapInArrow(_pairs, "row long, code long, n long")
        .withColumnRenamed("n", "times")
        .join(counts.where(F.col("n") < least), "code")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("cold_best"),
            F.sum(F.col("times") * F.col("n")).alias("cold_sum"),
        )
    )
    return valued.join(cold, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("cold_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("cold_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
