"""Benchmark decontamination by templates: also questions with other numbers, names or units.

A text becomes a row of template words: numbers, names and units are typed placeholders
that remember their value (a *slot*), other words stay, in lower case without punctuation.
A number is digits or a number word; a unit is a word of ``UNITS`` right after a number; a
name is a run of capitalised words that do not begin a sentence.

Windows of template words of the benchmark are hash-joined with those of the documents.
Windows of which less than half is literal words are left out, as they would match
anything; an item shorter than a window is one window of its own length. Windows of the
words as they are, without case and placeholders, are joined as well and their cover
counts too, so copies are found whatever they are made of and in any case. So are windows
of template words in which a capitalised word that begins a sentence is a name, as it may
be one. Matches of a
document and an item are laid along their diagonals, each form for itself. A diagonal counts if its slots are
consistent, that is if each value of the item stands for one value of the document; of an
inconsistent one only the windows without slots count. A document is contaminated by an
item if the counted windows cover at least ``LEAST_COVER`` of the item's words.

The hashes of the benchmark's windows are sent to the tasks to leave out windows that
match nothing, if there are at most ``MOST_SENT``; otherwise all windows are shuffled.

Cases: a NULL or empty text or item has no windows and never matches; repeated rows are
reported each; rows of equal id and other text are told apart; an empty benchmark or
table gives no rows and takes no document away; other columns are not read.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common
from truegrain.llm.pretokens import WordTable

WINDOW = 8
LEAST_COVER = 0.5
#: Hashes of windows sent to every task: 32 MB.
MOST_SENT = 4_000_000

LITERAL, NUMBER, NAME, UNIT, BREAK = range(5)

#: Forms of a text whose windows are joined: template words, words in any case without placeholders,
#: and template words of which capitalised ones that begin a sentence are names too.
PLACEHOLDERS, WORDS, BEGINS = range(3)
ALL_FORMS = (PLACEHOLDERS, WORDS, BEGINS)

NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion".split()
)
UNITS = set(
    "% percent mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms "
    "lb lbs pound pounds oz ounce ounces ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "$ € £ dollar dollars cent cents euro euros mph kmh km/h m/s hz khz mhz ghz kb mb gb tb w kw kwh v a j kj c f k "
    "degree degrees meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters".split()
)
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
_MONEY = re.compile(r"([$€£])([+-]?\d[\d.,]*)")
_MEASURE = re.compile(r"([+-]?\d[\d.,:/]*)(%|[a-z]+(?:/[a-z]+)?)")
_EDGES = string.punctuation.replace("%", "").replace("$", "") + "“”‘’«»„…–—¿¡€£"
_BREAK_SIGN = "\x00"


class Templates(WordTable):
    """Template words of whitespace-delimited pieces, remembered by piece.

    A piece has entries in ``ids`` that index the tables of kinds, values, capitals,
    sentence ends and values without case.
    """

    def _forget(self) -> None:
        super()._forget()
        none = np.zeros(0, bool)
        self.tables = (np.zeros(0, np.int8), np.zeros(0, np.uint64), none, none, np.zeros(0, np.uint64))
        self.fresh: list[tuple[int, str, bool, bool]] = []  # kind, word, capital, ends a sentence

    def _entry(self, *entry) -> int:
        self.fresh.append(entry)
        return len(self.tables[0]) + len(self.fresh) - 1

    def _piece(self, piece: str) -> list[int]:
        if piece == _BREAK_SIGN:
            return [self._entry(BREAK, "", False, True)]
        ends = piece.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…", ":")
        core = piece.strip(_EDGES) or piece.strip(_EDGES.replace("€", "").replace("£", ""))
        lower = core.lower()
        money = _MONEY.match(piece.lstrip("([\"'“"))
        if money:
            return [self._entry(NUMBER, money[2].rstrip(".,"), False, False), self._entry(UNIT, money[1], False, ends)]
        if not core:
            return []
        if _NUMBER.fullmatch(core) or lower in NUMBER_WORDS:
            return [self._entry(NUMBER, lower.rstrip(".,:/"), False, ends)]
        measure = _MEASURE.fullmatch(lower)
        if measure and measure[2] in UNITS:
            return [self._entry(NUMBER, measure[1].rstrip(".,"), False, False), self._entry(UNIT, measure[2], False, ends)]
        capital = core[0].isupper() and (len(core) == 1 or core[1:].islower())
        return [self._entry(UNIT if lower in UNITS else LITERAL, lower, capital, ends)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self._piece, words))
        if self.fresh:
            kinds, names, capitals, ends = zip(*self.fresh)
            values = common.words_of(["x" + n for n in names])[0]
            folded = common.words_of(["x" + n.casefold() for n in names])[0]
            new = (np.array(kinds, np.int8), values, np.array(capitals), np.array(ends), folded)
            self.tables = tuple(np.concatenate(t) for t in zip(self.tables, new))
            self.fresh = []
        ids = np.array([i for entries in found for i in entries], np.int64)
        return ids, np.fromiter(map(len, found), np.int64, len(found))

    def templates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kind and value of every template word, and where each text's begin."""
        return self.forms(texts, [PLACEHOLDERS])[PLACEHOLDERS][:3]

    def forms(self, texts: list[str], wanted: list[int]) -> dict[int, tuple]:
        """Of each form: kind and value of every word, where each text's begin, and the first entry of each word.

        The last array has an entry more than there are words.
        """
        pieces = [t.replace("\n", f" {_BREAK_SIGN} ").split() for t in texts]
        flat = [p for ps in pieces for p in ps]
        if not flat:
            none = np.zeros(0, np.int8), np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), np.zeros(1, np.int64)
            return dict.fromkeys(wanted, none)
        ids, sizes = self.ids_at(self.places(flat))
        total = np.concatenate([[0], np.cumsum(sizes)])
        bounds = total[np.cumsum([0, *map(len, pieces)])]
        kind, value, capital, ends, folded = (t[ids] for t in self.tables)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
        begins = first | np.concatenate([[True], ends[:-1]])[: len(ends)]
        after_number = ~first & np.concatenate([[False], kind[:-1] == NUMBER])[: len(kind)]
        kind = np.where((kind == UNIT) & ~after_number, LITERAL, kind)
        solid = np.flatnonzero(kind != BREAK)
        entry = np.cumsum(kind != BREAK) - 1

        def collapsed(kind):
            # A run of names is one name.
            again = ~first & (kind == NAME) & np.concatenate([[False], kind[:-1] == NAME])[: len(kind)]
            keep = (kind != BREAK) & ~again
            run = np.cumsum(~again) - 1
            place = np.arange(len(kind)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(kind))))
            joined = np.add.reduceat(common.mix(value + place.astype(np.uint64)), np.flatnonzero(~again)) if len(kind) else value
            named = np.where(kind == NAME, joined[run] if len(kind) else value, value)
            starts = np.append(entry[keep], len(solid))
            return kind[keep], named[keep], np.searchsorted(np.flatnonzero(keep), bounds), starts

        made = {}
        for form in wanted:
            if form == PLACEHOLDERS:
                made[form] = collapsed(np.where((kind == LITERAL) & capital & ~begins, NAME, kind))
            elif form == BEGINS:
                made[form] = collapsed(np.where((kind == LITERAL) & capital, NAME, kind))
            else:
                literal = np.full(len(solid), LITERAL, kind.dtype)
                made[form] = literal, folded[solid], np.searchsorted(solid, bounds), np.arange(len(solid) + 1)
        return made


def window_hashes(kind: np.ndarray, value: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the windows of ``size`` that lie in one text and are literal by half or more."""
    if len(kind) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = common.mix(np.where(kind == LITERAL, value, np.uint64(0)) + kind.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    count = len(kind) - size + 1
    found = np.full(count, size, np.uint64)
    for i in range(size):
        found = found * np.uint64(0x5851F42D4C957F2D) + word[i : i + count]
    literal = np.concatenate([[0], np.cumsum(kind == LITERAL)])
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    good = (owner[:count] == owner[size - 1 :]) & (2 * (literal[size:] - literal[:-size]) >= size)
    place = np.flatnonzero(good)
    return common.mix(found[place]), place


_WINDOW_SCHEMA = "form int, hash bigint, size int, place int, kinds array<int>, values array<bigint>"


def _window_columns(form, kind, value, at, place, hashes, size) -> dict:
    span = at[:, None] + np.arange(size)
    ends = np.arange(0, size * (len(at) + 1), size, dtype=np.int32)
    kinds, values = kind[span].ravel().astype(np.int32), value[span].ravel().view(np.int64)
    return {
        "form": pa.array(np.full(len(at), form, np.int32)),
        "hash": pa.array(hashes.view(np.int64)),
        "size": pa.array(np.full(len(at), size, np.int32)),
        "place": pa.array(place.astype(np.int32)),
        "kinds": pa.ListArray.from_arrays(pa.array(ends), pa.array(kinds)),
        "values": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
    }


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, size: int, forms=(PLACEHOLDERS,)) -> DataFrame:
    """The windows of every item: ``item``, ``words`` (of the item), ``first`` and ``cover`` and the window's columns.

    ``first`` and ``cover`` are the template words that the window covers. A name of more
    words than a window is covered by its last ones.
    """
    source = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        table = Templates()
        for piece in common.slices(batches, "text"):
            items = piece.column("item").to_pylist()
            for item, text in zip(items, common.texts_of(piece, "text")):
                made = table.forms([text], [PLACEHOLDERS, *forms])
                words = len(made[PLACEHOLDERS][0])
                begin, end = made[PLACEHOLDERS][3][:-1], made[PLACEHOLDERS][3][1:]
                for form in forms if words else ():
                    kind, value, bounds, starts = made[form]
                    own = min(size, len(kind))
                    hashes, at = window_hashes(kind, value, bounds, own)
                    first = np.searchsorted(np.maximum(begin, end - own), starts[at])
                    cover = np.searchsorted(end, starts[at + own], side="right") - first
                    hashes, at, first, cover = (x[cover > 0] for x in (hashes, at, first, cover))
                    if len(hashes):
                        columns = {
                            "item": pa.array([item] * len(at), pa.int64()),
                            "words": pa.array([words] * len(at), pa.int32()),
                            "first": pa.array(first.astype(np.int32)),
                            "cover": pa.array(cover.astype(np.int32)),
                        }
                        yield pa.RecordBatch.from_pydict(columns | _window_columns(form, kind, value, at, at, hashes, own))

    return source.mapInArrow(run, "item bigint, words int, first int, cover int, " + _WINDOW_SCHEMA)


def _document_windows(source: DataFrame, sizes: list[tuple[int, int]], sent) -> DataFrame:
    """Windows of the forms and sizes given; only those whose hash is in ``sent``, if there is one."""

    def work(piece: pa.RecordBatch, table: Templates):
        forms = table.forms(common.texts_of(piece, "text"), sorted({form for form, _ in sizes}))
        made = []
        for form, size in sizes:
            kind, value, bounds, _ = forms[form]
            hashes, at = window_hashes(kind, value, bounds, size)
            if sent is not None:
                known = sent.value
                hit = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
                hashes, at = hashes[hit], at[hit]
            owner = np.searchsorted(bounds, at, side="right") - 1
            columns = _window_columns(form, kind, value, at, at - bounds[owner], hashes, size)
            key = {c: piece.column(c).take(pa.array(owner)) for c in ("id", "tie")}
            made.append(pa.Table.from_batches([pa.RecordBatch.from_pydict(key | columns)]))
        found = pa.concat_tables(made).combine_chunks()
        return {n: found.column(n).combine_chunks() for n in found.column_names}

    return common.map_texts(source, "text", "id bigint, tie bigint, " + _WINDOW_SCHEMA, work, Templates)


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least_cover: float = LEAST_COVER,
    forms: tuple[int, ...] = (PLACEHOLDERS,),
) -> DataFrame:
    """A row for each document and item that contaminates it.

    ``id``, ``tie`` (hash of the text), ``item``, ``n_words`` of the item, ``n_covered``,
    ``n_slots`` different slots that were compared, ``n_changed`` of these with another value.
    ``forms``: ``ALL_FORMS`` for the whole job, as the queries do; the first alone finds only
    what its placeholders allow.
    """
    spark = df.sparkSession
    items = common.stored(item_windows(benchmark, item_col, item_text_col, window, forms), "templates")
    kinds = items.select("form", "size").distinct().limit(window * len(forms)).collect()
    sizes = sorted((r["form"], r["size"]) for r in kinds)
    sent = None
    if items.count() <= MOST_SENT:
        hashes = np.array([r["hash"] for r in items.select("hash").distinct().collect()], np.int64).view(np.uint64)
        sent = spark.sparkContext.broadcast(np.sort(hashes)) if len(hashes) else None
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    if not sizes:
        source = source.where(F.lit(False))
    d, i = _document_windows(source, sizes, sent).alias("d"), items.alias("i")
    same = [F.col(f"d.{c}") == F.col(f"i.{c}") for c in ("hash", "size", "form")]
    met = d.join(i, same[0] & same[1] & same[2])
    zipped = F.arrays_zip(F.col("i.kinds").alias("kind"), F.col("i.values").alias("own"), F.col("d.values").alias("theirs"))
    slots = F.filter(zipped, lambda s: s["kind"] != LITERAL)
    matched = met.select(
        "d.id", "d.tie", "i.item", "i.words", "i.form", "i.first", "i.cover",
        (F.col("d.place") - F.col("i.place")).alias("diagonal"), slots.alias("slots"),
    )
    # On a diagonal each window of the item stands once, however often the row is repeated.
    diagonals = (
        matched.groupBy("id", "tie", "item", "words", "form", "diagonal")
        .agg(F.collect_set(F.struct("first", "cover", "slots")).alias("windows"))
        .withColumn("pairs", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"]))))
        .withColumn("own", F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["own"]))))
        .withColumn("consistent", F.size("pairs") == F.size("own"))
    )
    counted = F.filter("windows", lambda w: F.col("consistent") | (F.size(w["slots"]) == 0))
    covered = F.flatten(F.transform(counted, lambda w: F.sequence(w["first"], w["first"] + w["cover"] - 1)))
    # A word that begins a sentence is known to be a name only if it was changed.
    told = F.filter("pairs", lambda p: (F.col("form") != BEGINS) | (p["own"] != p["theirs"]))
    agreed = F.when(F.col("consistent"), told).otherwise(F.array().cast("array<struct<kind:int,own:bigint,theirs:bigint>>"))
    per_item = (
        diagonals.select("id", "tie", "item", "words", covered.alias("covered"), agreed.alias("pairs"))
        .groupBy("id", "tie", "item", "words")
        .agg(F.collect_list("covered").alias("covered"), F.collect_list("pairs").alias("pairs"))
        .select(
            "id", "tie", "item", F.col("words").alias("n_words"),
            F.size(F.array_distinct(F.flatten("covered"))).alias("n_covered"),
            F.array_distinct(F.flatten("pairs")).alias("pairs"),
        )
    )
    return per_item.where(F.col("n_covered") >= F.lit(least_cover) * F.col("n_words")).select(
        "id", "tie", "item", "n_words", "n_covered",
        F.size("pairs").alias("n_slots"),
        F.size(F.filter("pairs", lambda p: p["own"] != p["theirs"])).alias("n_changed"),
    )


def clean_documents(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """``df`` without the documents that an item contaminates."""
    found = contaminated(df, benchmark, id_col, text_col, **{"forms": ALL_FORMS} | more).select(F.col("id").alias("_id"), F.col("tie").alias("_tie"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_tie"))
    return df.join(common.stored(found.distinct(), "contaminated"), same, "left_anti")
