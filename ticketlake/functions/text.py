"""Corpus text expressions: normalising, counting, ratios, chunking and tokens.

All patterns are linear on whole texts. Whitespace follows the Unicode definition.
"""
from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from ticketlake import rules as R
from ticketlake.functions import cleanse as X

# Character classes of the normaliser.
NOT_SPACE = r"[^\s\x0b\p{Z}\x85\x1c-\x1f]"
NOT_SPACE_OR_AT = r"[^\s\x0b\p{Z}\x85\x1c-\x1f@]"
SPACE = r"[\s\x0b\p{Z}\x85\x1c-\x1f]+"
WORD = r"[\p{L}\p{N}_]+"
HTML_TAG = r"<[^>\n]*>"
URL = rf"https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
# a whole run of non-blanks holding an '@' that is neither its first nor its last character
EMAIL = rf"(?<!{NOT_SPACE}){NOT_SPACE}{NOT_SPACE_OR_AT}*+@{NOT_SPACE}+"
IPV4 = r"(?U)\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
TICKET_ID = r"(ticket|inc|req)[-_ ]?\p{Nd}+"
REPEATED_MARK = r"([!?.,])\1+"
SYMBOLS = r"[^a-zA-Z0-9\-_./]+"
SYMBOLS_UNICODE = r"[^\p{L}\p{N}\-_./]+"


def strip_html(col) -> Column:
    return F.regexp_replace(X._c(col), HTML_TAG, " ")


def clean_text(col, ascii_only: bool = True) -> Column:
    """Normalise: lower, then tags, links, mail addresses, IPv4, ticket ids, repeated marks, symbols, blanks.

    The order matters. ``ascii_only=False`` keeps letters of other scripts.
    """
    out = F.lower(F.coalesce(X._c(col), F.lit("")))
    for pattern in (HTML_TAG, URL, EMAIL, IPV4, TICKET_ID):
        out = F.regexp_replace(out, pattern, " ")
    out = F.regexp_replace(out, REPEATED_MARK, "$1")
    return F.trim(F.regexp_replace(out, SYMBOLS if ascii_only else SYMBOLS_UNICODE, " "))


def remove_boilerplate(col, phrases=R.NOISE_PHRASES) -> Column:
    """Remove the phrases in their order, then collapse blanks."""
    out = X._c(col)
    for phrase in phrases:
        out = F.replace(out, F.lit(phrase), F.lit(" "))
    return F.trim(F.regexp_replace(out, SPACE, " "))


def words(col) -> Column:
    """Blank-separated words; an empty array for a blank text."""
    return F.array_remove(F.split(F.coalesce(X._c(col), F.lit("")), SPACE), "")


def clean_words(col) -> Column:
    """Words of a cleaned text, whose only blanks are single spaces."""
    return F.array_remove(F.split(X._c(col), " "), "")


def word_count(col) -> Column:
    return F.size(words(col))


def repetition_ratio(word_array: Column) -> Column:
    n = F.size(word_array)
    return F.when(n == 0, 0.0).otherwise(1 - F.size(F.array_distinct(word_array)) / F.nullif(n.cast("double"), F.lit(0.0)))


def unique_word_ratio(word_array: Column) -> Column:
    n = F.size(word_array)
    return F.when(n == 0, 0.0).otherwise(F.size(F.array_distinct(word_array)) / F.nullif(n.cast("double"), F.lit(0.0)))


def avg_word_length(word_array: Column) -> Column:
    n = F.size(word_array)
    chars = F.char_length(F.array_join(word_array, ""))
    return F.when(n == 0, 0.0).otherwise(chars / F.nullif(n.cast("double"), F.lit(0.0)))


def char_ratio(col, pattern: str) -> Column:
    """Share of characters that belong to ``pattern`` (a character class)."""
    c = F.coalesce(X._c(col), F.lit(""))
    n = F.char_length(c)
    hit = n - F.char_length(F.regexp_replace(c, pattern, ""))
    return F.when(n == 0, 0.0).otherwise(hit / F.nullif(n.cast("double"), F.lit(0.0)))


def uppercase_ratio(col) -> Column:
    return char_ratio(col, r"\p{Lu}+")


def digit_ratio(col) -> Column:
    return char_ratio(col, r"\p{Nd}+")


def special_char_ratio(col) -> Column:
    return char_ratio(col, r"[^a-zA-Z0-9\s\x0b\p{Z}\x85\x1c-\x1f]+")


def complexity(avg_len, unique_ratio, n_words) -> Column:
    return X._c(avg_len) * 0.4 + X._c(unique_ratio) * 0.4 + X._c(n_words) / 100 * 0.2


def row_mean(*cols) -> Column:
    """Mean over the given columns, a missing value counting as zero."""
    return sum((F.coalesce(X._c(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0)) / len(cols)


def token_estimate(n_words) -> Column:
    """One token for every 0.75 words."""
    return F.floor(X._c(n_words) / F.lit(0.75)).cast("int")


def bm25_tokens(col) -> Column:
    """Lower-case word characters of any script."""
    return F.regexp_extract_all(F.lower(F.coalesce(X._c(col), F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def index_tokens(col) -> Column:
    """Index variant: tokens of at least two characters."""
    return F.filter(bm25_tokens(col), lambda t: F.char_length(t) >= 2)


def query_tokens(col) -> Column:
    """Query variant: lower-case, split on blanks."""
    return words(F.lower(X._c(col)))


def chunks(word_array: Column, size: int = R.CHUNK_SIZE, overlap: int = R.CHUNK_OVERLAP) -> Column:
    """Sliding word windows as an array of texts; the contained tail window is kept."""
    n = F.size(word_array)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.array_join(F.slice(word_array, s + 1, F.lit(size)), " "))


def expand_query(col, table=R.QUERY_EXPANSION, fix_case: bool = False) -> Column:
    """Append the words of the first phrase found in the lower-cased query.

    Keys are matched as written, so upper-case keys never match; ``fix_case`` lowers them.
    """
    text = X._c(col)
    lowered = F.lower(text)
    out = None
    for key, extra in table:
        cond = lowered.contains(key.lower() if fix_case else key)
        value = F.concat(text, F.lit(" " + extra))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(text)


def metadata_json(*cols) -> Column:
    """JSON text of the named columns, NULL values kept as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def retrieval_document(problem, solution, category, priority, product, language, level, breached) -> Column:
    """Structured text of a solved incident."""

    def known(col):
        return F.coalesce(X._c(col).cast("string"), F.lit("unknown"))

    def body(col, absent):
        return F.coalesce(X.null_if_blank(col), F.lit(absent))

    return F.concat_ws(
        "\n",
        F.lit("[PROBLEM]"), body(problem, "No problem description available."),
        F.lit("[RESOLUTION]"), body(solution, "No resolution description available."),
        F.lit("[CONTEXT]"),
        F.concat(F.lit("Category  : "), known(category)),
        F.concat(F.lit("Priority  : "), known(priority)),
        F.concat(F.lit("Product   : "), known(product)),
        F.concat(F.lit("Language  : "), known(language)),
        F.concat(F.lit("Escalation: "), known(level)),
        F.concat(F.lit("SLA Status: "), F.when(X.is_true(X._c(breached)), "breached").otherwise("met")),
    )


# ---- repeated phrases: no built-in expresses this on long texts, so small Arrow helpers ------------
def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


#: Where a word begins or ends.
_EDGE = re.compile(r"\b")


def _boundary(s: str, i: int) -> bool:
    left = i > 0 and _is_word(s[i - 1])
    right = i < len(s) and _is_word(s[i])
    return left != right


def _phrase_sizes(ids: np.ndarray) -> list[int]:
    """Phrase sizes that can repeat at all.

    From six words on all four-grams of the inner words recur at exactly that distance, so the distances
    between equal four-grams that are frequent enough will do. Texts of mostly one four-gram try every size.
    """
    n = len(ids)
    sizes = list(range(1, min(5, n // 2) + 1))
    if n < 12:
        return sizes
    g = ids.astype(np.int64)
    gram = ((g[:-3] * 1_000_003 + g[1:-2]) * 1_000_003 + g[2:-1]) * 1_000_003 + g[3:]
    order = np.argsort(gram, kind="stable")
    ordered = gram[order]
    counts = np.diff(np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))))
    if counts.max() > n // 2:
        return sizes + list(range(6, n // 2 + 1))
    found = np.zeros(n, np.int64)
    for lag in range(1, int(counts.max())):
        equal = np.flatnonzero(ordered[lag:] == ordered[:-lag])
        found += np.bincount(order[equal + lag] - order[equal], minlength=n)
    return sizes + [m for m in np.flatnonzero(found).tolist() if 6 <= m <= n // 2 and found[m] >= m - 5]


@dataclass
class Kinds:
    """By token of a text: of word characters only, opens with one, closes with one, has one; first and last character; length."""

    plain: np.ndarray
    opens: np.ndarray
    closes: np.ndarray
    wordy: np.ndarray
    first: np.ndarray
    last: np.ndarray
    length: np.ndarray

    def part(self, rows) -> "Kinds":
        return Kinds(*(getattr(self, f.name)[rows] for f in fields(self)))


_ASCII_ALNUM = np.array([chr(c).isalnum() for c in range(128)])
_ASCII_WORD = np.array([_is_word(chr(c)) for c in range(128)])


def _kinds(tokens: pa.StringArray) -> Kinds:
    _, offsets, values = tokens.buffers()
    at = np.frombuffer(offsets, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1].astype(np.int64)
    chars = np.frombuffer(values or b"", np.uint8)[: at[-1]]
    if len(chars) and chars.max() >= 128:
        each = tokens.to_pylist()
        made = [(t.isalnum(), t != "" and _is_word(t[0]), t != "" and _is_word(t[-1]), any(map(_is_word, t)), ord(t[:1] or "\0"), ord(t[-1:] or "\0"), len(t)) for t in each]
        return Kinds(*(np.array(x, kind) for x, kind in zip(zip(*made), [bool] * 4 + [np.int64] * 3)))
    length = np.diff(at)
    if not len(chars):
        chars = np.zeros(1, np.uint8)
    first, last = (np.where(length > 0, chars[np.clip(k, 0, len(chars) - 1)], 0).astype(np.int64) for k in (at[:-1], at[1:] - 1))
    # characters that are not of a word are few, so the tokens are told from these
    other, apart = (np.bincount(np.searchsorted(at, np.flatnonzero(~x[chars[at[0] : at[-1]]]) + at[0], side="right") - 1, minlength=len(length)) for x in (_ASCII_ALNUM, _ASCII_WORD))
    return Kinds((other == 0) & (length > 0), _ASCII_WORD[first], _ASCII_WORD[last], apart < length, first, last, length)


def _repeat_periods(tokens: list[str], ids: np.ndarray, kinds: Kinds) -> tuple[np.ndarray, np.ndarray]:
    """Token indices, in order, and phrase sizes (three words and more) worth verifying there, smallest first.

    The inner words have to recur one phrase ahead. A token whose phrase certainly repeats at some
    size needs no larger ones, which keeps texts of one repeated word linear.
    """
    n = len(tokens)
    plain, settled = kinds.plain, ~kinds.wordy
    places, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in _phrase_sizes(ids):
        same = ids[: n - m] == ids[m:]
        hits = np.flatnonzero(same)
        last = n - 2 * m + 1  # number of tokens with room for two copies
        if m >= 3 and len(hits) >= m - 2:
            # the words between the first and the last one of the phrase recur
            inner = hits[: len(hits) - m + 3]
            inner = inner[hits[m - 3 :] - inner == m - 3] - 1
            inner = inner[(inner >= 0) & (inner < last)]
            inner = inner[~settled[inner] & (same[inner] | ~plain[inner])]
            # and its last word recurs or begins a word of several parts
            end, copy = inner + m - 1, inner + 2 * m - 1
            begins = ~plain[copy] & (kinds.first[end] == kinds.first[copy]) & (kinds.length[end] < kinds.length[copy])
            inner = inner[same[end] | begins | (kinds.length[end] == 0)]
            other = np.flatnonzero(~plain[inner] & ~same[inner])
            if len(other):
                inner = np.delete(inner, [k for k in other.tolist() if not tokens[inner[k]].endswith(tokens[inner[k] + m])])
            places.append(inner)
            sizes.append(np.full(len(inner), m))
        if len(hits) >= m:
            sure = hits[: len(hits) - m + 1]
            sure = sure[hits[m - 1 :] - sure == m - 1]
            sure = sure[sure < last]
            settled[sure[kinds.opens[sure] & kinds.closes[sure + m - 1]]] = True
    place, size = np.concatenate(places), np.concatenate(sizes)
    order = np.argsort(place, kind="stable")
    return place[order], size[order]


def _short_repeats(ids: np.ndarray, kinds: Kinds) -> tuple[np.ndarray, np.ndarray]:
    """By token, whether a phrase of one and of two words that starts in it may follow itself, told by ids, ends and lengths."""
    n = len(ids)
    plain, first, last, length = kinds.plain, kinds.first, kinds.last, kinds.length
    a, b = slice(0, n - 1), slice(1, n)
    one = np.zeros(n, bool)
    # the next word begins with the word, or the word ends with the next one, or both have several parts
    one[a] = (ids[a] == ids[b]) | (plain[a] & ~plain[b] & (first[a] == first[b]) & (length[a] < length[b]))
    one[a] |= ~plain[a] & (~plain[b] | ((last[a] == last[b]) & (length[a] > length[b])))
    two = np.zeros(n, bool)
    if n > 3:
        a, b, c, d = (slice(k, n - 3 + k) for k in range(4))
        two[a] = ((first[b] == first[d]) | (length[b] == 0)) & ((ids[a] == ids[c]) | (~plain[a] & (last[a] == last[c]) & (length[a] > length[c])))
    return one, two


def collapse_repeats(s: str) -> str:
    """Collapse ``phrase phrase ...`` to ``phrase``: leftmost start, shortest phrase first.

    Expects single blanks (a cleaned text). A phrase ends and its copy begins at a blank, so the
    candidates come from comparing words at a fixed distance; each is then verified on characters.
    """
    tokens = s.split(" ")
    words = pa.array(tokens, pa.string())
    return _collapsed(s, tokens, np.asarray(words.dictionary_encode().indices), _kinds(words))


def _collapsed(s: str, tokens: list[str], ids: np.ndarray, kinds: Kinds) -> str:
    n = len(tokens)
    if n < 2:
        return s
    longer, period = _repeat_periods(tokens, ids, kinds)
    one, two = _short_repeats(ids, kinds)
    near = one | two
    near[longer] = True
    queue = np.flatnonzero(near).tolist()
    if not queue:
        return s
    ends = np.cumsum(kinds.length + 1) - 1
    starts, ends = (ends - kinds.length).tolist(), ends.tolist()
    out: list[str] = []
    done = at = 0  # everything before `done` is already written
    inside = -1  # the token that the last phrase ended in
    while at < len(queue) or inside >= 0:
        if inside >= 0:
            j, sizes, inside = inside, None, -1
        else:
            j = queue[at]
            at += 1
            if ends[j] <= done:
                continue
            sizes = [m for m, maybe in ((1, one), (2, two)) if maybe[j]]
            sizes += period[np.searchsorted(longer, j) : np.searchsorted(longer, j + 1)].tolist()
        a, b, ended = starts[j], ends[j], done
        for i in [a] if tokens[j].isalnum() else [a + e.start() for e in _EDGE.finditer(tokens[j])]:
            if i < done or i == b:
                continue
            # in the rest of a token that the previous phrase ended in, every size whose copy begins alike
            for m in (np.flatnonzero(kinds.first[j + 1 : j + 1 + (n - j) // 2] == ord(s[i])) + 1).tolist() if sizes is None else sizes:
                second = starts[j + m]
                length = second - 1 - i
                if s.startswith(s[i:b], second) and s.startswith(s[i : second - 1], second) and _boundary(s, second + length):
                    phrase = s[i : second - 1]
                    end, again = second - 1, " " + phrase
                    while s.startswith(again, end) and _boundary(s, end + len(again)):
                        end += len(again)
                    out += [s[done:i], phrase]
                    done = end
                    break
        if done > ended:
            k = bisect_right(starts, done) - 1
            if starts[k] < done < ends[k]:
                inside = k
            while at < len(queue) and queue[at] <= k and (k == inside or ends[queue[at]] <= done):
                at += 1
    out.append(s[done:])
    return "".join(out)


def collapse_batch(texts: pa.Array, rows: int = 64) -> pa.Array:
    """`collapse_repeats` of every text; only ``rows`` of a batch are Python objects at a time, and their words are numbered together."""
    done = []
    for k in range(0, len(texts), rows):
        part = texts.slice(k, rows)
        split = pc.split_pattern(part, " ")
        words = split.flatten()
        ids, kinds = np.asarray(words.dictionary_encode().indices), _kinds(words)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)).tolist()
        done.append(pa.array([
            None if t is None else _collapsed(t, t.split(" "), ids[a:b], kinds.part(slice(a, b))).strip() for t, a, b in zip(part.to_pylist(), [0, *ends], ends)
        ], pa.string()))
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def remove_repeated_phrases(texts: pa.Array) -> pa.Array:
    return collapse_batch(texts)


def spaced_words(col) -> Column:
    """Lower-case words (`w`) with the white space after each (`s`); `s` is a full stop where more than that follows."""
    word, other = r"[\p{L}\p{N}_]+", r"[^\p{L}\p{N}_]*"
    pairs = F.regexp_extract_all(F.lower(F.coalesce(X._c(col), F.lit(""))), F.lit(f"({word}{other})"), F.lit(1))

    def split(token: Column) -> Column:
        after = F.regexp_replace(token, f"^{word}", "")
        blank = after.rlike(r"^[\s\x0b\p{Z}\x85\x1c-\x1f]+$")
        return F.struct(F.regexp_extract(token, f"^{word}", 0).alias("w"), F.when(blank, after).otherwise(F.lit(".")).alias("s"))

    return F.transform(pairs, split)


def has_repeated_pattern(words, low: int = 2, high: int = 6) -> Column:
    """Whether a phrase of ``low``..``high`` words, white space included, follows itself: over `spaced_words`, a pass per length.

    A word is marked B if it and the space after it recur one phrase ahead, and w if only the word does; white space has
    to follow either. A phrase is a row of Bs that a B or w ends.
    """
    found = F.lit(False)
    for size in range(low, high + 1):
        found = found | F.array_join(_ahead(X._c(words), size), "").rlike(f"B{{{size - 1}}}[Bw]")
    return found


def _ahead(words: Column, size: int) -> Column:
    def mark(x: Column, i: Column) -> Column:
        y = F.get(words, i + size)
        recurs = (x["w"] == y["w"]) & (x["s"] != ".")
        return F.when(recurs & (x["s"] == y["s"]), "B").when(recurs, "w").otherwise("0")

    return F.transform(words, mark)
