"""URL filters: glob rules run as one bit-parallel wildcard automaton.

Every glob is laid out as a run of bits: bit j says "the first j symbols have
matched".  All globs share one bit vector of 64-bit words, so a character moves
all of them at once:

    D' = carry((D & advance[c]) << 1) | (D & loop[c])

``advance[c]`` marks the bits whose next symbol accepts ``c`` (Shift-And),
``loop[c]`` the bits that stand before a star.  ``?`` is one character but
``/``, ``*`` any run without ``/``, ``**`` any run.  numpy steps a whole batch
of URLs of like length together; length is not limited.

The canonical URL is host (A-Z lower-cased) plus path: what follows the first
``://`` up to ``/``, ``?``, ``#``; then up to ``?``, ``#``.  A null URL or one
without ``://`` has both empty.  Among matching rules the longest wins, then the
first given.  Equal rows give equal results; extra columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.llm.common import fresh, lower_ascii, text_batches

CELLS = 1 << 21  # characters stepped together


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs that fit one of ``globs``; ``name`` is shown, ``weight`` decides."""

    name: str
    globs: tuple[str, ...]
    verdict: str
    weight: int


def site_rule(site: str, verdict: str) -> Rule:
    """Rule for a host and its subdomains whose path starts with the site's path (``example.net/en/``)."""
    return Rule(site, (f"{site}**", f"*.{site}**"), verdict, len(site))


def host_glob(glob: str, verdict: str) -> Rule:
    """Rule for hosts that fit ``glob``, whatever the path; weaker than every site rule."""
    return Rule(glob, (glob, f"{glob}/**"), verdict, 0)


class GlobAutomaton:
    """Multiword Shift-And masks of many globs."""

    def __init__(self, globs: list[str]):
        symbols: list[list[tuple[str, str]]] = []  # per glob: (symbol, star that stands before it)
        tails: list[str] = []
        for g in globs:
            out, star, i = [], "", 0
            while i < len(g):
                if g[i] == "*":
                    deep = g[i:i + 2] == "**"
                    star = "**" if deep or star == "**" else "*"
                    i += 2 if deep else 1
                    continue
                out.append((g[i], star))
                star = ""
                i += 1
            symbols.append(out)
            tails.append(star)
        chars = sorted({c for s in symbols for c, _ in s if c != "?"} | {"/"})
        self.classes = {c: k + 1 for k, c in enumerate(chars)}  # 0: any other character
        n_bits = sum(len(s) + 1 for s in symbols)
        self.words = max(1, -(-n_bits // 64))
        shape = (len(chars) + 1, self.words)
        self.advance, self.loop = np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, np.uint64]] = []
        bit = 0
        slash = self.classes["/"]
        for s, tail in zip(symbols, tails):
            self._set(self.start, bit)
            for c, star in [*s, ("", tail)]:
                for k in range(len(chars) + 1):
                    if c == "?" and k != slash or c and k == self.classes.get(c):
                        self._set(self.advance[k], bit)
                    if star == "**" or star == "*" and k != slash:
                        self._set(self.loop[k], bit)
                bit += 1
            self.accept.append(((bit - 1) // 64, np.uint64(1 << ((bit - 1) % 64))))

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << (bit % 64))

    def _codes(self, text: str) -> np.ndarray:
        u = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return self.lookup()[np.minimum(u, 0x10FFFF)]

    def lookup(self) -> np.ndarray:
        got = self.__dict__.get("_lookup")
        if got is None:
            got = np.zeros(0x110000, dtype=np.uint16)
            for c, k in self.classes.items():
                got[ord(c)] = k
            self.__dict__["_lookup"] = got
        return got

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_lookup"}

    def _step(self, d: np.ndarray, c: np.ndarray) -> np.ndarray:
        moved = d & self.advance[c]
        out = moved << np.uint64(1)
        if self.words > 1:
            out[:, 1:] |= moved[:, :-1] >> np.uint64(63)
        return out | (d & self.loop[c])

    def match(self, texts: list[str]) -> np.ndarray:
        """Boolean matrix: text x glob."""
        out = np.zeros((len(texts), len(self.accept)), dtype=bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            end, longest = at, 0
            while end < len(order):
                longest = max(longest, len(texts[order[end]]))
                if end > at and longest * (end + 1 - at) > CELLS:
                    break
                end += 1
            rows = order[at:end]
            lens = np.array([len(texts[i]) for i in rows])
            width = int(lens[-1])
            codes = np.zeros((len(rows), width), dtype=np.uint16)
            for k, i in enumerate(rows):
                codes[k, :lens[k]] = self._codes(texts[i])
            d = np.repeat(self.start[None, :], len(rows), axis=0)
            first = 0  # rows are sorted by length: those before ``first`` have ended
            for j in range(width):
                while lens[first] <= j:
                    first += 1
                d[first:] = self._step(d[first:], codes[first:, j])
            for g, (w, m) in enumerate(self.accept):
                out[rows, g] = (d[:, w] & m) != 0
            at = end
        return out


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow",
               into: str = "url_filter") -> DataFrame:
    """``df`` with the struct ``into``: host, path, rule (name or null), verdict."""
    text_batches(df.sparkSession, 8192)
    ranked = sorted(rules, key=lambda r: -r.weight)  # stable: of equals the first given
    owner = np.array([k for k, r in enumerate(ranked) for _ in r.globs])
    shared = df.sparkSession.sparkContext.broadcast(GlobAutomaton([g for r in ranked for g in r.globs]))
    names, verdicts = [r.name for r in ranked], [r.verdict for r in ranked]

    @F.pandas_udf("rule string, verdict string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            hit = shared.value.match(list(urls))
            best = np.where(hit.any(axis=1), owner[hit.argmax(axis=1)], -1) if len(owner) else np.full(len(urls), -1)
            yield pd.DataFrame({"rule": pd.Series([names[k] if k >= 0 else None for k in best], dtype=object),
                                "verdict": [verdicts[k] if k >= 0 else default for k in best]})

    host, path = host_of(F.col(url)), path_of(F.col(url))
    h, p, v = fresh(df, "__h", "__p", "__v")
    out = df.withColumns({h: host, p: path}).withColumn(v, run.asNondeterministic()(F.concat(h, p)))
    return out.withColumn(into, F.struct(F.col(h).alias("host"), F.col(p).alias("path"), F.col(v)["rule"].alias("rule"),
                                         F.col(v)["verdict"].alias("verdict"))).drop(h, p, v)
