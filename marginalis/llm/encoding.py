"""Text decoded with the wrong character encoding: found and restored by
expectation-maximization (problem 9).

Each word with characters beyond ASCII has a latent encoding chain: clean, or
"these bytes were really in A (twice over, for double damage) but read as B".
Given a chain, the word is what a model of clean text makes likely after the
chain is undone.  Chain frequencies per source and language, and the model of
clean text itself, are estimated together from all records, so that words too
weak to tell by themselves lean on the rest of their source and record.
"""

from __future__ import annotations

import codecs
import heapq
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain as chain_
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalis.session import cut, spread

# Encodings that bytes are mistaken for, and that texts were really in.
READ_AS = ("latin-1", "cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "cp1256", "cp437", "cp850", "cp866", "koi8-r", "mac-roman")
REALLY_IN = ("cp1252", "cp1250", "cp1251", "cp1253", "cp1256", "koi8-r", "mac-roman", "cp437", "cp866")
TWICE = (("latin-1", "latin-1"), ("cp1252", "cp1252"), ("cp1252", "latin-1"), ("latin-1", "cp1252"), ("mac-roman", "mac-roman"), ("cp437", "cp437"), ("cp1252", "mac-roman"), ("mac-roman", "cp1252"))

#: Chain 0 is clean, the last one lost: bytes that were replaced when the text was read.
CHAINS: tuple[tuple[str, ...], ...] = (
    ("clean",),
    *((w, "utf-8") for w in READ_AS),
    *((b, "utf-8", a, "utf-8") for a, b in TWICE),
    *((w, r) for w in READ_AS for r in REALLY_IN if w != r and {w, r} != {"latin-1", "cp1252"}),
    ("lost",),
)
LOST = len(CHAINS) - 1

#: Sizes of the model's tables, fixed whatever the input.  The most frequent
#: languages have a table of letter pairs each; the others share the last one.
LANGUAGES, BUCKETS, WORDS = 32, 1 << 16, 1 << 18

#: Bits of the filter that tells which words have more than one likely reading.
FILTER = 1 << 25

#: Words of the vocabulary in a task, and groups up to which their frequencies go out with a join.
TASK_WORDS, SMALL = 20_000, 20_000

#: Bytes that cp1252 leaves undefined; readers put a replacement character for them.
UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)


@cache
def letters_of(name: str) -> str:
    """The 256 characters of a one-byte encoding, control characters for undefined bytes."""
    return "".join(bytes([b]).decode(name, "replace").replace("\ufffd", chr(b)) for b in range(256))


@cache
def encoder(name: str):
    return codecs.charmap_build(letters_of(name))


def to_bytes(text: str, name: str) -> bytes | None:
    try:
        return codecs.charmap_encode(text, "strict", encoder(name))[0]
    except UnicodeEncodeError:
        return None


def undo(text: str, chain: tuple[str, ...]) -> str | None:
    """The text before the damage, or None if the chain can't have made it."""
    for wrong, real in zip(chain[::2], chain[1::2], strict=True):
        raw = to_bytes(text, wrong)
        if raw is None:
            return None
        try:
            text = raw.decode(real)
        except UnicodeDecodeError:
            return None
    return text


def _script(ch: str) -> int:
    """0 for what belongs to any script, 9 for controls and drawing characters."""
    code = ord(ch)
    if code < 32 or 0x7F <= code < 0xA0 or 0x2500 <= code < 0x2600 or 0xE000 <= code < 0xF900:
        return 9
    if not ch.isalpha():
        return 0
    return 1 if code < 0x250 or 0x1E00 <= code < 0x1F00 else 2 if 0x370 <= code < 0x400 else 3 if 0x400 <= code < 0x530 else 4 if 0x600 <= code < 0x780 else 5


@cache
def script_of_bytes(name: str) -> bytes:
    return bytes(_script(c) for c in letters_of(name))


@cache
def one_byte_chains() -> dict[str, list[tuple[int, str]]]:
    made: dict[str, list[tuple[int, str]]] = {}
    for i, chain in enumerate(CHAINS[1:LOST], 1):
        if "utf-8" not in chain:
            made.setdefault(chain[0], []).append((i, chain[1]))
    return made


def readings(word: str) -> list[tuple[int, str]]:
    """(chain, text) for each chain that may have made the word; clean first.

    Chains between one-byte encodings undo almost anything; only those that
    give one script without control characters count.  A word with replacement
    characters has each of its fillings.
    """
    if "\ufffd" in word:
        return [(LOST, "".join(made)) for made in product(*(fillings(word) or [[word]]))]
    out, seen = [(0, word)], {word}

    def add(i: int, made: str) -> None:
        if made not in seen:
            seen.add(made)
            out.append((i, made))

    for i, chain in enumerate(CHAINS[1:LOST], 1):
        if "utf-8" in chain:
            made = undo(word, chain)
            if made is not None and not any("\x80" <= c <= "\x9f" for c in made):
                add(i, made)
    for wrong, reals in one_byte_chains().items():
        raw = to_bytes(word, wrong)
        if raw is None:
            continue
        for i, real in reals:
            scripts = set(raw.translate(script_of_bytes(real))) - {0}
            if len(scripts) < 2 and 9 not in scripts:
                add(i, raw.decode("latin-1").translate(_table(real)))
    return out


@cache
def _table(name: str) -> dict[int, str]:
    return dict(enumerate(letters_of(name)))


def fillings(word: str) -> list[list[str]] | None:
    """The letters that may have stood at each place of a word with replacement
    characters, if UTF-8 was read as cp1252; None if it can't have been.

    What cp1252 leaves undefined are inner bytes of UTF-8 only, so the bytes
    that are left tell where letters begin, and places don't depend on each
    other.  No word that goes on begins with a combining mark.
    """
    table = {c: b for b, c in enumerate(letters_of("cp1252"))}
    if any(ch != "\ufffd" and ch not in table for ch in word):
        return None
    raw, out, at = [UNDEFINED if ch == "\ufffd" else (table[ch],) for ch in word], [], 0
    while at < len(raw):
        lead = raw[at][0]
        end = at + (1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
        letters = []
        for made in product(*raw[at:end]):
            try:
                letters.append(bytes(made).decode("utf-8"))
            except UnicodeDecodeError:
                continue
        if not letters:
            return None
        out.append(letters)
        at = end
    if len(out) > 1:
        out[0] = [c for c in out[0] if not unicodedata.category(c).startswith("M")] or out[0]
    return out


_SPLIT = re.compile(r"([ \t\r\n]+)")
_WORD = re.compile(r"[^ \t\r\n]+")


def odd_words(text: str) -> list[str]:
    return [w for w in _WORD.findall(text) if not w.isascii()]


def _bucket(a: str, b: str) -> int:
    return (ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA77) % 0xFFFFFFFB % BUCKETS


def pairs_of(text: str) -> list[tuple[int, int]]:
    """(bucket of the two letters, bucket of the first alone) along a word;
    digits are one letter, so are the ends."""
    shown = "\x02" + re.sub(r"\d", "0", text) + "\x03"
    return [(_bucket(a, b), _bucket(a, "\x01")) for a, b in zip(shown, shown[1:], strict=False)]


def word_bucket(text: str) -> int:
    return zlib.crc32(re.sub(r"\d+", "0", text).encode("utf-8", "surrogatepass")) % WORDS


def pair_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``pairs_of`` gives, for many texts at once: (buckets of the pairs,
    buckets of the first letters, number of pairs of each text)."""
    joined = re.sub(r"\d", "0", "".join(f"\x02{t}\x03" for t in texts))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    inside = np.ones(len(codes), dtype=bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    at = np.flatnonzero(inside)
    first, second = codes[at] * np.uint64(0x9E3779B1), codes[at + 1] * np.uint64(0x85EBCA77)
    code = lambda x: (x % np.uint64(0xFFFFFFFB) % np.uint64(BUCKETS)).astype(np.int64)
    return code(first + second), code(first + np.uint64(0x85EBCA77)), sizes


@cache
def of_one_byte() -> np.ndarray:
    """Whether a chain is between one-byte encodings, by its number."""
    return np.array([0 < i < LOST and "utf-8" not in c for i, c in enumerate(CHAINS)])


def sparse(table: np.ndarray) -> tuple:
    """(shape, places, values) of the cells that aren't 0."""
    at = np.flatnonzero(table)
    return table.shape, at.astype(np.int32), table.reshape(-1)[at]


def dense(cells: tuple) -> np.ndarray:
    shape, at, values = cells
    out = np.zeros(int(np.prod(shape)), dtype=values.dtype)
    out[at] = values
    return out.reshape(shape)


class Model:
    """The model of clean text, pairs of letters per language and how often
    words occur, and the frequencies of chains over all groups.

    ``single`` scores by single letters instead of pairs.  The first round
    does, as the first counts hold the damaged words as they stand: given its
    first letter the rest of a damaged word is no less likely than that of the
    meant one, but each of its letters is rarer.
    """

    def __init__(self, overall: np.ndarray | None, letters: np.ndarray, words: np.ndarray, languages: dict[str, int], single: bool = False):
        self.overall, self.letters, self.words, self.languages, self.single = overall, letters, words, languages, single
        self.all = letters.sum(axis=0)
        self.size = letters.sum(axis=1) / 2
        self._priors: dict[str | None, np.ndarray] = {}

    def __getstate__(self) -> dict:
        # most cells are empty, and the model goes out with every round
        return {"overall": self.overall, "languages": self.languages, "single": self.single, "letters": sparse(self.letters), "words": sparse(self.words)}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["overall"], dense(state["letters"]), dense(state["words"]), state["languages"], state["single"])

    def language(self, name: str | None) -> int:
        return self.languages.get(name or "", LANGUAGES - 1)

    def log_prior(self, counted: str | None) -> np.ndarray:
        """Frequencies of chains in a group from its own counts ('chain:count'
        by blanks).  It leans on all groups: as much as on 20 words of its own,
        and for a fifth in any case."""
        if self.overall is None:
            out = np.full(len(CHAINS), 0.5 / (len(CHAINS) - 1))
            out[0] = 0.5
            return np.log(out)
        if counted not in self._priors:
            if len(self._priors) > 100_000:
                self._priors.clear()
            own = 20.0 * self.overall
            for item in (counted or "").split():
                chain, weight = item.split(":")
                own[int(chain)] += float(weight)
            self._priors[counted] = np.log(np.maximum(0.8 * own / own.sum() + 0.2 * self.overall, 1e-7))
        return self._priors[counted]

    def log_pair(self, pair: np.ndarray | int, first: np.ndarray | int, language: np.ndarray | int) -> np.ndarray:
        base = (self.all[pair] + 1e-3) / (self.all[first] + 50.0)
        return np.log((self.letters[language, pair] + 20.0 * base) / (self.letters[language, first] + 20.0))

    def scores(self, chains: np.ndarray, texts: list[str], marks: np.ndarray, starts: np.ndarray, languages: np.ndarray, pairs: tuple | None = None) -> np.ndarray:
        """Log likelihood of readings of words, without the chains' frequencies.

        The readings of a word follow each other from ``starts``, the word as
        it stands first.  A chain between one-byte encodings is held against
        how much rarer its reading is than the word as it stands.
        """
        pair, first, sizes = pairs or pair_codes(texts)
        per_pair = np.repeat(languages, sizes)
        if self.single:
            base = (self.all[first] + 1e-3) / (self.size.sum() + 50.0)
            logs = np.log((self.letters[per_pair, first] + 20.0 * base) / (self.size[per_pair] + 20.0))
        else:
            logs = self.log_pair(pair, first, per_pair)
        raw = np.repeat(marks[starts], np.diff(np.append(starts, len(texts))))
        attested = np.minimum(0.0, np.log((self.words[marks] + 1.0) / (self.words[raw] + 1.0)))
        return np.add.reduceat(logs, np.cumsum(sizes) - sizes) + np.where(of_one_byte()[chains], attested, 0.0)


#: Readings this much less likely than the word as it stands (a natural
#: logarithm) are left out: no record's chain frequencies could make up for it.
HOPELESS = 16.0

#: A word counts as damaged if the chance that it is meant as it stands is no
#: larger; less for words of a single letter or sign, which fit many chains.
CLEAN, CLEAN_THIN = 0.5, 0.1


def posterior(chains: np.ndarray, scores: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    score = log_prior[chains] + scores
    score = np.exp(score - score.max())
    return score / score.sum()


#: Fillings of a word that are looked up as words, the likeliest by their pairs
#: of letters; the others count by their pairs alone.
LOOKED_UP = 625

#: The chance from which the likeliest filling is taken for what was meant.
CLEAR = 0.9


def refill(word: str, model: Model, language: int) -> tuple[str, bool]:
    """(likeliest filling of a word with replacement characters, whether it
    clearly wins); the word as it stands if there is none.

    Weighed by pairs of letters and by how often the filling occurs as a word.
    Beginnings that end alike go on alike, so the likeliest of each and the
    chance of all are carried along, however many bytes are lost.
    """
    letters = fillings(word)
    if letters is None:
        return word, False
    shown = lambda c: "0" if c.isdecimal() else c
    begun, chance = {"\x02": [(0.0, "")]}, {"\x02": 0.0}
    for options in [*letters, ["\x03"]]:
        further, sums = {}, {}
        for ch in options:
            step = {last: float(model.log_pair(_bucket(shown(last), shown(ch)), _bucket(shown(last), "\x01"), language)) for last in begun}
            further[ch] = heapq.nlargest(LOOKED_UP, ((s + step[last], made + ch) for last, starts in begun.items() for s, made in starts))
            sums[ch] = float(np.logaddexp.reduce([chance[last] + step[last] for last in begun]))
        begun, chance = further, sums
    made = [text[:-1] for _, text in begun["\x03"]]
    by_pairs = np.exp(np.array([s for s, _ in begun["\x03"]]) - chance["\x03"])
    weights = by_pairs * np.array([model.words[word_bucket(t)] + 1.0 for t in made])
    # what isn't looked up may be as frequent as any word
    rest = max(0.0, 1.0 - by_pairs.sum()) * (model.words.max() + 1.0) if math.prod(map(len, letters)) > LOOKED_UP else 0.0
    k = int(np.argmax(weights))
    return made[k], bool(weights[k] >= CLEAR * (weights.sum() + rest))


def _named(documents: DataFrame, source: str, lang: str) -> DataFrame:
    """``documents`` with its group, a source and a language, and its language."""
    plain = lambda c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    return documents.withColumns({GROUP: F.concat(plain(source), F.lit("\x1f"), plain(lang)), LANGUAGE: plain(lang)})


#: Names of columns that no table has.
GROUP, LANGUAGE, COUNTED = "marginalis group", "marginalis language", "marginalis counted"


def vocabulary(documents: DataFrame, text: str, source: str, lang: str) -> DataFrame:
    """(word, grp, language, n): words beyond ASCII, counted over all records."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str], Counter] = {}
            for body, g, la in zip(batch[text], batch[GROUP], batch[LANGUAGE], strict=True):
                if isinstance(body, str) and not body.isascii():
                    seen.setdefault((g, la), Counter()).update(odd_words(body))
            yield pd.DataFrame([(w, *k, n) for k, words in seen.items() for w, n in words.items()], columns=["word", "grp", "language", "n"])

    rows = _named(spread(documents.select(text, source, lang)), source, lang).select(text, GROUP, LANGUAGE).mapInPandas(count, "word string, grp string, language string, n long")
    return rows.groupBy("word", "grp", "language").agg(F.sum("n").alias("n"))


_LISTED = "grp string, language string, n long, word string, chains array<int>, texts array<string>, marks array<int>"


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = {w: readings(w) for w in batch["word"].unique()}
        options = [found[w] for w in batch["word"]]
        yield pd.DataFrame(
            {
                **{c: batch[c] for c in ("grp", "language", "n", "word")},
                "chains": [[c for c, _ in o] for o in options], "texts": [[t for _, t in o] for o in options], "marks": [[word_bucket(t) for _, t in o] for o in options],
            }
        )


def _flat(batch: pd.DataFrame) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The readings of a batch's words in a row: (chains, texts, marks, where
    each word's begin, how many it has)."""
    sizes = batch["chains"].map(len).to_numpy()
    return np.concatenate(batch["chains"].to_list()), list(chain_.from_iterable(batch["texts"])), np.concatenate(batch["marks"].to_list()), np.cumsum(sizes) - sizes, sizes


def fit(words: DataFrame, rounds: int = 4) -> tuple[Model, DataFrame | None, DataFrame]:
    """Estimate the model from a vocabulary by ``rounds`` of EM: (model, counts
    of chains per group as (grp, counted), the readings of all words).

    Each round is one pass over the vocabulary.  Sums over tables of fixed size
    reach the driver; the counts of groups, of which there may be any number,
    stay in the cluster and meet the words in the next round by a join.
    """
    # words with lost bytes are no evidence of clean text: they are read by it when they are repaired
    words = cut(words.where(~F.col("word").contains("\ufffd")))
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, words.count() // TASK_WORDS)
    listed = cut(words.repartition(tasks, "word").mapInPandas(_list, _LISTED))
    frequent = words.groupBy("language").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "language").limit(LANGUAGES - 1).collect()
    languages = {r["language"]: i for i, r in enumerate(frequent)}
    model, counts = None, None
    for n in range(rounds + 1):
        sent = words.sparkSession.sparkContext.broadcast((model, languages))
        sums = cut(
            with_counts(listed, "grp", counts)
            .mapInPandas(_expect(sent), "part int, grp string, i int, j int, weight double")
            .groupBy("part", "grp", "i", "j")
            .agg(F.sum("weight").alias("weight"))
        )
        # written: nothing asks for the model of this round again
        sent.destroy()
        got = sums.where("part > 0").drop("grp").toPandas()
        tables = [np.zeros((LANGUAGES, BUCKETS)), np.zeros((1, WORDS))]
        for part, filled in enumerate(tables, 1):
            rows = got[got["part"] == part]
            filled[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["weight"].to_numpy()
        overall = None
        if model is not None:
            overall = np.full(len(CHAINS), 1e-2)
            for r in sums.where("part = 0").groupBy("j").agg(F.sum("weight").alias("weight")).collect():
                overall[r["j"]] += r["weight"]
            overall /= overall.sum()
            items = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "j", "weight"))), " ")
            counts = cut(sums.where("part = 0").groupBy("grp").agg(items.alias("counted")))
        model = Model(overall, tables[0], tables[1][0], languages, single=n == 0)
    return model, counts, listed


def with_counts(df: DataFrame, group: str, counts: DataFrame | None) -> DataFrame:
    """``df`` with its group's counts of chains, null for a group without any.

    Counts of few groups go out whole (a group's take up to two kilobytes, so
    SMALL of them some megabytes, mostly far less); of more Spark chooses the join.
    """
    if counts is None:
        return df.withColumn(COUNTED, F.lit(None).cast("string"))
    named = counts.select(F.col("grp").alias(f"{GROUP} of counts"), F.col("counted").alias(COUNTED))
    named = F.broadcast(named) if counts.count() <= SMALL else named
    return df.join(named, F.col(f"`{group}`") == F.col(f"`{GROUP} of counts`"), "left").drop(f"{GROUP} of counts")


def _expect(sent):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, languages = sent.value
        letters, seen = np.zeros(LANGUAGES * BUCKETS), np.zeros(WORDS)
        for batch in batches:
            if batch.empty:
                continue
            chains, texts, marks, starts, sizes = _flat(batch)
            spoken = np.array([languages.get(x, LANGUAGES - 1) for x in batch["language"]])
            if model is None:
                # as they stand
                texts, marks, chains, sizes = [texts[i] for i in starts], marks[starts], chains[starts], np.ones(len(starts), dtype=np.int64)
                post = np.ones(len(texts))
            names, known = pd.factorize(batch["grp"])
            word = np.repeat(np.arange(len(batch)), sizes)
            pairs = pair_codes(texts)
            if model is not None:
                scores = model.scores(chains, texts, marks, starts, spoken[word], pairs)
                scores = np.where(scores > scores[starts][word] - HOPELESS, scores, -np.inf)
                own = batch.groupby(names)[COUNTED].first()
                priors = np.stack([model.log_prior(own[i] if isinstance(own[i], str) else None) for i in range(len(known))])
                scores = scores + priors[names[word], chains]
                post = np.exp(scores - np.maximum.reduceat(scores, starts)[word])
                post /= np.add.reduceat(post, starts)[word]
            weight = np.where(post < 1e-4, 0.0, post) * batch["n"].to_numpy()[word]
            np.add.at(seen, marks, weight)
            pair, first, lengths = pairs
            each, place = np.repeat(weight, lengths), np.repeat(spoken[word], lengths) * BUCKETS
            np.add.at(letters, place + pair, each)
            np.add.at(letters, place + first, each)
            table = np.bincount(names[word] * len(CHAINS) + chains, weight)
            at = np.flatnonzero(table)
            yield pd.DataFrame({"part": 0, "grp": known[at // len(CHAINS)], "i": 0, "j": at % len(CHAINS), "weight": table[at]})
        for part, table, width in ((1, letters, BUCKETS), (2, seen, WORDS)):
            at = np.flatnonzero(table)
            yield pd.DataFrame({"part": part, "grp": "", "i": at // width, "j": at % width, "weight": table[at]})

    return run


def _bits(word: str, language: str) -> tuple[int, int]:
    data = f"{language}\x1f{word}".encode("utf-8", "surrogatepass")
    return zlib.crc32(data) % FILTER, zlib.crc32(data, 0x5BD1E995) % FILTER


#: How likely words of the narrow filter are at least to be meant otherwise (a
#: natural logarithm, as ``Reader.leans`` gives it).
NARROW = -9.0


def open_words(listed: DataFrame, model: Model) -> np.ndarray:
    """Two filters, as 64 bits a number: of the words that have a likely
    reading beside themselves, and of those that lean to it by NARROW.  They
    never leave one out; others may look as if they had one, the more the
    larger the vocabulary, and are then found not to."""
    sent = listed.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted, bits = sent.value, np.zeros((2, FILTER // 64), dtype=np.uint64)
        for batch in batches:
            batch = batch.drop_duplicates(["word", "language"])
            if batch.empty:
                continue
            chains, texts, marks, starts, sizes = _flat(batch)
            word = np.repeat(np.arange(len(batch)), sizes)
            spoken = np.array([fitted.language(x) for x in batch["language"]])
            gains = fitted.scores(chains, texts, marks, starts, spoken[word])
            gains = gains - gains[starts][word]
            gains[starts] = -np.inf
            gains = np.where(gains > -HOPELESS, gains, -np.inf)
            most = np.maximum.reduceat(gains, starts)
            with np.errstate(invalid="ignore", divide="ignore"):
                # a trifle more, so that rounding can't leave one out
                lean = np.where(np.isfinite(most), most + np.log(np.add.reduceat(np.exp(gains - most[word]), starts)) + 1e-6, -np.inf)
            for narrow, chosen in enumerate((lean > -np.inf, lean >= NARROW)):
                for w, la in zip(batch["word"][chosen], batch["language"][chosen], strict=True):
                    for bit in _bits(w, la):
                        bits[narrow, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        flat = bits.reshape(-1)
        at = np.flatnonzero(flat)
        yield pd.DataFrame({"i": at, "bits": flat[at].view(np.int64)})

    got = listed.mapInPandas(run, "i long, bits long").groupBy("i").agg(F.bit_or("bits").alias("bits")).toPandas()
    sent.destroy()
    out = np.zeros(2 * FILTER // 64, dtype=np.uint64)
    out[got["i"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out.reshape(2, -1)


#: A word is read more closely if the chance that it is meant otherwise could
#: pass this (a natural logarithm) in the most damaged record of its length.
CONTESTED = -4.0


class Reader:
    """Reads words by a fitted model, each once."""

    def __init__(self, model: Model, filter_: np.ndarray):
        self.model, self.filter = model, filter_
        self._lean: dict[tuple[str, int], dict[str, float]] = {}
        self._read: dict[tuple[str, str], tuple] = {}

    def leans(self, words: set[str], language: str, least: float) -> dict[str, float]:
        """How much likelier than as they stand words are to be meant
        otherwise, were all chains as frequent (natural logarithms); minus
        infinity for words that surely lean less than ``least``."""
        narrow = int(least >= NARROW)
        known, filter_ = self._lean.setdefault((language, narrow), {}), self.filter[narrow]
        if len(known) > 500_000:
            known.clear()
        for w in [w for w in words if w not in known]:
            if "\ufffd" in w:
                known[w] = math.inf
            elif all(int(filter_[b // 64]) >> (b % 64) & 1 for b in _bits(w, language)):
                scores = self.read(w, language)[2]
                known[w] = float(np.logaddexp.reduce(scores[1:] - scores[0])) if len(scores) > 1 else -math.inf
            else:
                known[w] = -math.inf
        return known

    def read(self, word: str, language: str) -> tuple[list[tuple[int, str]], np.ndarray, np.ndarray, bool]:
        """(likely readings, their chains, scores, whether it is clear what
        was meant by a word with lost bytes)."""
        key = (word, language)
        if key not in self._read:
            if len(self._read) > 200_000:
                self._read.clear()
            spoken = self.model.language(language)
            if "\ufffd" in word:
                made, clear = refill(word, self.model, spoken)
                self._read[key] = [(LOST, made)], np.array([LOST]), np.zeros(1), clear
            else:
                options = readings(word)
                chains = np.array([c for c, _ in options])
                texts = [t for _, t in options]
                scores = self.model.scores(chains, texts, np.array([word_bucket(t) for t in texts]), np.zeros(1, dtype=np.int64), np.full(len(texts), spoken))
                keep = np.flatnonzero(scores > scores[0] - HOPELESS)
                self._read[key] = [options[i] for i in keep], chains[keep], scores[keep], True
        return self._read[key]


def repair_text(text: str, reader: Reader, log_prior: np.ndarray, language: str) -> tuple[str, int, list[str], bool]:
    """(restored text, words damaged, chains, whether all of it is restored).

    The record's own words shift the chain frequencies of its group: two rounds
    of EM within the record.  They can't make a chain more frequent against
    clean words than all of them together would; words that would be clean even
    then count as clean from the start.
    """
    odd = odd_words(text)
    least = CONTESTED - math.log((len(odd) + 20) / 20) + log_prior[0]
    lean = reader.leans(set(odd), language, least)
    contested = Counter(w for w in odd if lean[w] >= least)
    if not contested:
        return text, 0, [], True
    found = {w: reader.read(w, language) for w in contested}
    mass = 20.0 * np.exp(log_prior)
    mass[0] += len(odd) - contested.total()
    mass[LOST] += sum(n for w, n in contested.items() if found[w][1][0] == LOST)
    several = [w for w in contested if len(found[w][0]) > 1]
    prior, posts = log_prior, {}
    for _ in range(3 if several else 0):
        posts = {w: posterior(found[w][1], found[w][2], prior) for w in several}
        mixed = mass.copy()
        for w in several:
            np.add.at(mixed, found[w][1], contested[w] * posts[w])
        prior = np.log(mixed / mixed.sum())
    changed, used, whole = {}, set(), True
    for w in contested:
        if w not in posts:
            (chain, made), whole = found[w][0][0], whole and found[w][3]
        else:
            k = int(np.argmax(posts[w]))
            chain, made = found[w][0][k]
            if chain == 0 or posts[w][0] > (CLEAN if sum(map(str.isalpha, w)) > 1 else CLEAN_THIN):
                continue
        used.add("<".join(CHAINS[chain]))
        changed[w] = made
    if not changed:
        return text, 0, [], True
    return "".join(changed.get(w, w) for w in _SPLIT.split(text)), sum(contested[w] for w in changed), sorted(used), whole


def restore(documents: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", rounds: int = 4) -> DataFrame:
    """Add ``garbled`` (boolean), ``restored`` (text), ``chains`` (array) and
    ``whole`` (whether everything garbled could be restored; lost bytes are if
    one filling clearly wins, otherwise the likeliest is put in).

    A text is garbled if one of its words is more likely to come from a wrong
    decoding than to be meant as it stands (by nine to one if it has but one
    letter or sign), or holds replacement characters.  Null, empty and pure ASCII texts aren't garbled
    and come back as they are; null and blank sources are one source, and so
    are languages; letter case and blanks around them don't count.  Repeated
    rows are treated alike; an empty table gives an empty one.  Texts are read
    whole, whatever their length.  Columns with the names of the added ones are
    replaced.

    Plan: one pass counts words beyond ASCII with map-side combine; their
    readings are listed once; a fixed number of vectorised passes over the
    vocabulary estimates the model; one pass repairs the records.  It looks
    closer only at records with a word that a filter of fixed size lets
    through.  Every source and language has chain frequencies of its own, which
    come by a join.  Only tables of fixed size reach the driver and go out with
    the tasks.
    """
    documents = documents.drop("garbled", "restored", "chains", "whole")
    model, counts, listed = fit(vocabulary(documents, text, source, lang), rounds)
    names = documents.columns
    schema = T.StructType(
        [
            *documents.schema.fields,
            T.StructField("garbled", T.BooleanType()),
            T.StructField("restored", T.StringType()),
            T.StructField("chains", T.ArrayType(T.StringType())),
            T.StructField("whole", T.BooleanType()),
        ]
    )
    sent = documents.sparkSession.sparkContext.broadcast((model, sparse(open_words(listed, model))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted, filter_ = sent.value
        reader = Reader(fitted, dense(filter_))
        for batch in batches:
            rows = []
            for body, la, counted in zip(batch[text], batch[LANGUAGE], batch[COUNTED], strict=True):
                if not isinstance(body, str) or body.isascii():
                    rows.append((False, body, [], True))
                    continue
                made, damaged, used, whole = repair_text(body, reader, fitted.log_prior(counted if isinstance(counted, str) else None), la)
                rows.append((damaged > 0, made, used, whole))
            yield pd.concat([batch[names].reset_index(drop=True), pd.DataFrame(rows, columns=["garbled", "restored", "chains", "whole"])], axis=1)

    return with_counts(_named(spread(documents), source, lang), GROUP, counts).mapInPandas(run, schema)
