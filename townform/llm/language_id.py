"""Language identification by cross-parsing entropy.

For each language the suffix automaton of a sample of labelled text is built. A text is parsed
against it: a phrase is the longest piece that occurs in the sample, then the next phrase begins.
The language that needs the fewest phrases per character wins; equal counts go to the smaller name.

The sample is the fit: of each language at most ``FIT_DOCS`` labelled documents, drawn by a hash of
identifier and text, and of each of these a passage, drawn anywhere in the text, of ``FIT_CHARS``
characters shared among them. It travels with the tasks; every worker builds the automata once. Every letter of the samples has its own symbol, in any script; the
transitions of all automata lie in one array, each state's row shifted to where its places are free
(some 2 MB per language).

Every whole text is parsed. It is cut into blocks of ``BLOCK`` characters, phrases end with their
block, and all blocks of a batch move through all automata at once, one character per step.

Letters are lower-cased; everything else is a blank. Letters that a sample lacks end a phrase.

Cases: a null text or one without a letter is ``und`` with score 0. Null languages teach nothing;
without any labelled text all is ``und``. Repeated documents are each judged; of the fit one stays. Empty tables give
empty results; other columns do not matter. The score is the winner's share of ``exp(-phrases)``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIT_DOCS, FIT_CHARS, BLOCK, CHARS = 48, 24_000, 1024, 1 << 20
SPARE, TRIES, LOW = 4, 64, (1 << 32) - 1
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)], bool)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, blanks for what is no letter, and the offsets of the texts."""
    low = [t.lower() for t in texts]
    offsets = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=offsets[1:])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letters()[points], points, 32), offsets


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all pieces of ``text``; state 0 is the start."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


def placed(automata: list[list[dict[int, int]]], symbols: int) -> tuple[np.ndarray, list[list[int]]]:
    """One array of all transitions, and the names of the states of each automaton.

    A state is named by the shift of its row: its step by symbol c lies at name + c, as name << 32 | next
    name. Names are unique, so an entry of another state is told apart. Rows with many steps come first;
    a row that fits nowhere in ``TRIES`` drawn shifts goes behind the end.
    """
    size = symbols + SPARE * sum(len(moves) for go in automata for moves in go)
    taken, names, draw, end = bytearray(size + symbols + 1), set(), 1, size
    name = [[0] * len(go) for go in automata]
    for k, state in sorted(((k, i) for k, go in enumerate(automata) for i in range(len(go))), key=lambda r: -len(automata[r[0]][r[1]])):
        moves = automata[k][state]
        for _ in range(TRIES):
            draw = (draw * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF
            at = (draw >> 32) % end
            if at not in names and not any(taken[at + c] for c in moves):
                break
        else:
            at, end = end + symbols, end + 2 * symbols + 1
            taken.extend(bytes(end + symbols + 1 - len(taken)))
        names.add(at)
        name[k][state] = at
        for c in moves:
            taken[at + c] = 1
    table = np.full(len(taken), -1, np.int64)
    for k, go in enumerate(automata):
        for state, moves in enumerate(go):
            for c, to in moves.items():
                table[name[k][state] + c] = name[k][state] << 32 | name[k][to]
    return table, name


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Symbol of each code point, the steps of all languages, and the languages' start states.

    Symbol 0 is a letter that no sample has. The steps are the array of ``placed`` and, for each language
    and symbol, the state in which the next phrase begins.
    """
    points, _ = codes([text for _, text in samples])
    seen, count = np.unique(points, return_counts=True)
    symbol = np.zeros(0x110000, np.int32)
    symbol[seen[np.argsort(-count, kind="stable")]] = np.arange(1, len(seen) + 1)
    automata = [suffix_automaton(symbol[codes([text])[0]].tolist()) for _, text in samples]
    table, name = placed(automata, len(seen))
    again = np.empty((len(automata), len(seen) + 1), np.int64)
    for k, go in enumerate(automata):
        again[k] = name[k][0]
        for c, to in go[0].items():
            again[k, c] = name[k][to]
    return symbol, (table, again), np.array([n[0] for n in name], np.int64)


def phrases(symbols: np.ndarray, offsets: np.ndarray, steps: tuple[np.ndarray, np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Phrases that each language (row) needs for each text (column)."""
    table, again = steps
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    pieces = -(-lengths // BLOCK)
    row = np.repeat(np.arange(n), pieces)
    begin = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * BLOCK
    size = np.minimum(BLOCK, offsets[row + 1] - begin)
    order = np.argsort(-size, kind="stable")
    row, begin, size = row[order], begin[order], size[order]
    state = np.repeat(starts[:, None], len(row), 1)
    count = np.zeros(state.shape, np.int32)
    live = len(row)
    for t in range(int(size[0]) if live else 0):
        live = int(np.searchsorted(-size[:live], -t, "left"))
        here, symbol = state[:, :live], symbols[begin[:live] + t]
        step = table[here + symbol]
        ends = step >> 32 != here
        count[:, :live] += ends
        state[:, :live] = np.where(ends, again[:, symbol], step & LOW)
    count += 1  # the phrase at hand
    total = np.zeros((len(starts), n), np.int64)
    for k in range(len(starts)):
        total[k] = np.bincount(row, count[k], n)
    return total


def _judge(samples: tuple[tuple[str, str], ...]):
    names = [name for name, _ in samples]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, steps, starts = parser(samples) if names else (None, None, None)
        for batch in batches:
            ids, held, texts = batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2).to_pylist()
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end] or "") <= CHARS):
                    size += len(texts[end] or "")
                    end += 1
                points, offsets = codes([t or "" for t in texts[begin:end]])
                lettered = np.diff(np.concatenate([[0], np.cumsum(points != 32)])[offsets]) > 0
                if names:
                    total = phrases(symbol[points], offsets, steps, starts)
                    best = total.argmin(0)
                    share = 1 / np.exp(np.clip(total.min(0) - total, -50, 0)).sum(0)
                else:
                    lettered[:] = False
                said = [names[b] if ok else "und" for b, ok in zip(best, lettered)] if names else ["und"] * (end - begin)
                score = np.where(lettered, share, 0.0) if names else np.zeros(end - begin)
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), held.slice(begin, end - begin), pa.array(said, pa.string()),
                                                  pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
                begin = end
    return run


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS) -> tuple[tuple[str, str], ...]:
    """A bounded sample of text for each language. ``labelled``: id, text, lang.

    Reads the table twice: for the documents drawn of all languages, then for their passages.
    """
    rows = labelled.where("lang IS NOT NULL AND text <> ''").withColumn("print", F.xxhash64("id", "text"))
    # the limit on the rank reaches below the exchange, so a task sends at most fit_docs rows of a language
    least = Window.partitionBy("lang").orderBy("print")
    drawn = rows.select("lang", "print").withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= fit_docs).select("lang", "print").distinct()
    drawn = drawn.select("lang", "print", F.floor(F.lit(fit_chars) / F.count("*").over(Window.partitionBy("lang"))).cast("int").alias("size"))
    size = F.greatest("size", F.lit(1))
    place = F.pmod(F.xxhash64("print"), F.greatest(F.length("text") - size + 1, F.lit(1)).cast("long")).cast("int") + 1
    passages = (rows.join(F.broadcast(drawn), ["lang", "print"])  # at most fit_docs rows of a language are broadcast
                .select("lang", "print", F.substring("text", place, size).alias("passage")).distinct())
    samples: dict[str, list[str]] = {}
    for r in sorted(passages.collect()):
        samples.setdefault(r["lang"], []).append(r["passage"])
    return tuple((name, " ".join(parts)) for name, parts in samples.items())


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(_judge(samples), RESULT).withColumnRenamed("doc_id", key)
