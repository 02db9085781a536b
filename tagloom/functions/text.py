"""Tag normalisation as Catalyst expressions (no Python in the data path).

The tokeniser of one tag string is defined recursively:

    T(x) = let L = split(x') where x' = clean(rewrite(singular(fold(x))))
           L == []            -> []
           L == [x]           -> [x]                 (compare with the raw input)
           L == [w], w != x   -> concat of T(c) for c in split(clean(rewrite(w)))
           otherwise          -> concat of T(c) for c in L

``tokenize`` evaluates T to its fixpoint inside one expression: the pending
strings live in an ``array<struct<s,d>>`` (``d`` = final) and an
``aggregate`` over ``sequence(1, n)`` applies one expansion round while any
entry is pending; a string that were still pending then is an error.  Every helper binds intermediate values once through
``_let`` so the interpreted lambdas never evaluate a sub-expression twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

STATE_TYPE = "array<struct<s:string,d:boolean>>"
JAVA_SPACE = "[ \\t\\n\\x0B\\f\\r]"
_JAVA_SPACE_CHARS = "\t\n\x0b\x0c\r"
_STRIP_CLASS = "[\\p{InCombiningDiacriticalMarks}\\p{IsM}\\p{IsLm}\\p{IsSk}]+"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


_CONTROL_AND_SPACE = "".join(chr(i) for i in range(0x21))
# Characters the fold can change besides letter case: anything outside ASCII,
# plus the two ASCII modifier symbols '^' and '`'.
_FOLD_CANDIDATE = "[^\\x00-\\x5D\\x5F\\x61-\\x7F]"


def java_trim(c: Column) -> Column:
    """Strip every code point <= U+0020 from both ends (Java ``String.trim``)."""
    return F.btrim(c, F.lit(_CONTROL_AND_SPACE))


def fold(c: Column) -> Column:
    """trim, lower-case, canonical decomposition and removal of marks,
    modifier letters and modifier symbols (accents, ``^``, `````, ``´``).

    Pure-ASCII strings without '^' or '`' skip the translate table and the
    mark-class scan (neither can change them)."""
    src, dst = C.accent_fold_table()

    def body(low):
        plain = F.when(low.rlike(_HANGUL), _hangul_letters(low)).otherwise(low)
        return F.when(low.rlike(_FOLD_CANDIDATE),
                      F.regexp_replace(F.translate(plain, src, dst), _STRIP_CLASS, "")).otherwise(low)
    return _let(F.lower(java_trim(c)), body)


_HANGUL = f"[{C.HANGUL_FIRST}-{C.HANGUL_LAST}]"


def _hangul_letters(s: Column) -> Column:
    """Every Hangul syllable replaced by its two or three conjoining letters."""
    def letters(names):
        return F.array(*map(F.lit, names))

    def split(c):
        n = F.ascii(c) - ord(C.HANGUL_FIRST)
        rest = F.pmod(n, F.lit(588))
        return F.when(c.rlike(_HANGUL), F.concat(
            F.get(letters(C.HANGUL_LEADING), F.floor(n / 588).cast("int")),
            F.get(letters(C.HANGUL_VOWELS), F.floor(rest / 28).cast("int")),
            F.get(letters(C.HANGUL_TRAILING), F.pmod(n, F.lit(28))))).otherwise(c)
    return F.array_join(F.transform(F.split(s, ""), split), "")


def _uncountable_pattern() -> str:
    return "(^|[^a-z0-9_])(" + "|".join(C.UNCOUNTABLE_WORDS) + ")$"


# Last characters of every string some singular rule can change (each rule
# ends in one of them), plus the one rule anchored only at the start.
_SINGULAR_ENDINGS = ["s", "n", "i", "e", "a"]
_SINGULAR_START = "oxen"


def singular(c: Column) -> Column:
    """Singular form of the last word (first matching rule, see constants).

    An O(1) guard on the last character skips the rule chain for strings no
    rule can change (most long tag lines end in punctuation), so the 33
    patterns only scan candidates."""
    def body(s):
        expr = F.when(~(F.right(s, F.lit(1)).isin(_SINGULAR_ENDINGS) | s.startswith(_SINGULAR_START)), s)
        expr = expr.when(s.rlike(_uncountable_pattern()), s)
        for pattern, repl in C.SINGULAR_RULES:
            expr = expr.when(s.rlike(pattern), F.regexp_replace(s, pattern, repl))
        return expr.otherwise(s)
    return _let(c, body)


def _full(pattern: str) -> str:
    return "^(?:" + pattern + ")$"


# Rules 1-10 of REWRITE_RULES cannot match a string without a digit, ':' or
# ';' or 'canon'; rules 11-16 are anchored at the start and cheap to test.
_REWRITE_GUARDED = 10
_REWRITE_TRIGGER = "[0-9:;]|canon"


def rewrite(c: Column) -> Column:
    """First whole-string metadata rewrite that applies (or the input).

    One find of ``_REWRITE_TRIGGER`` decides whether the ten unanchored
    rules (each a full-string backtracking match) need testing at all."""
    def body(s):
        return _let(s.rlike(_REWRITE_TRIGGER), lambda g: _rules(s, g))

    def _rules(s, g):
        expr = None
        for i, (_, pattern, repl) in enumerate(C.REWRITE_RULES):
            full = _full(pattern)
            if repl == C.DOT_TO_SPACE:
                value = F.translate(s, ".", " ")
            elif repl == C.DASH_TO_SPACE:
                value = F.translate(s, "-", " ")
            else:
                value = F.regexp_replace(s, full, repl)
            cond = s.rlike(full)
            if i < _REWRITE_GUARDED:
                cond = g & cond
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        return expr.otherwise(s)
    return _let(c, body)


def clean(c: Column) -> Column:
    """Entity fix, punctuation to spaces, '..' removed, '--' to '-', white
    space to spaces and the bare 'bw' spelled 'b&w' (to be split by
    ``split_words``)."""
    # Java whitespace runs become single spaces in the reference; every caller
    # splits on single spaces and drops empty pieces, so mapping each
    # whitespace character to a space (in the same pass as the punctuation;
    # neither can create or break '..', '--' or '&amp;') gives the same words
    # without a regex pass that rewrites every space.  The SQL twin keeps the
    # reference's order and collapse.
    c = F.replace(c, F.lit("&amp;"), F.lit("&"))
    c = F.translate(c, C.PUNCTUATION + _JAVA_SPACE_CHARS, " " * (len(C.PUNCTUATION) + len(_JAVA_SPACE_CHARS)))
    c = F.replace(c, F.lit(".."), F.lit(""))
    c = F.replace(c, F.lit("--"), F.lit("-"))
    # '^bw$' as Java reads it ('$' may also sit before one final line
    # terminator); the O(1) guard spares the regex scan on every other line.
    return _let(c, lambda v: F.when(v.startswith("bw") & (F.length(v) <= 3),
                                    F.regexp_replace(v, "^bw$", "b&w")).otherwise(v))


def split_words(c: Column) -> Column:
    """trim, split on single spaces, keep words longer than one character."""
    return F.filter(F.split(java_trim(c), " "), lambda t: F.length(t) > 1)


def rewrite_split(c: Column) -> Column:
    return split_words(clean(rewrite(c)))


def _entry(s: Column, done: bool) -> Column:
    return F.struct(s.alias("s"), F.lit(done).alias("d"))


def expand(x: Column) -> Column:
    """One recursion step of T: the strings T(x) is the concatenation of
    (entries with d = true are final)."""
    def body(words):
        first = F.get(words, 0)
        return (F.when(F.size(words) == 0, F.array().cast(STATE_TYPE))
                .when((F.size(words) == 1) & (first == x), F.array(_entry(x, True)))
                .when(F.size(words) == 1, F.transform(rewrite_split(first), lambda w: _entry(w, False)))
                .otherwise(F.transform(words, lambda w: _entry(w, False))))
    return _let(rewrite_split(singular(fold(x))), body)


def expand_strings(x: Column) -> Column:
    """Child strings of one recursion step (used on whole tag lines)."""
    return F.transform(expand(x), lambda e: e["s"])


def _round(state: Column) -> Column:
    return F.flatten(F.transform(state, lambda e: F.when(e["d"], F.array(e)).otherwise(expand(e["s"]))))


def tokenize(x: Column) -> Column:
    """Final tokens of T(x) (order of the recursion, duplicates kept).

    A round is a no-op once every entry is final.  Each recursion level either
    shortens the strings or normalises them, so ``2 * length(x) + 8`` rounds
    reach the fixpoint; the query fails if they should ever not, rather than
    give out an unfinished string as a token.
    """
    unfinished = F.raise_error(F.concat(F.lit("no fixpoint for tag word: "), x))
    return F.transform(tokenize_state(x), lambda e: F.when(e["d"], e["s"]).otherwise(unfinished))


# Words of ASCII letters, perhaps with a final dot, that no rewrite can touch.
_PLAIN_WORD = "^[a-z]{2,}\\.?$"


# What a singular rule can match in a word that does not end in s.
_NOT_S = "(en|eople|ice|[ti]a|i)$|^oxen"


def _untouched(s: Column) -> Column:
    """True if only the singular rules can change a plain word."""
    return ~s.contains("canon") & (s != "bw")


def tokens(x: Column) -> Column:
    """T(x) like ``tokenize``, without the rounds where they cannot matter.

    For a plain word w (T(w.) = T(w): the dot becomes a space) each recursion
    step is one singular step, so T(w) is w itself if no rule can change it, or
    its singular if that is stable; all else takes the general way."""
    def word(w):
        end = w.endswith("s") | w.rlike(_NOT_S)

        def changed(s):
            stable = (s == singular(s)) & _untouched(s)
            return (F.when(s == w, F.array(s)).when(F.length(s) < 2, F.array().cast("array<string>"))
                    .when(stable, F.array(s)).otherwise(tokenize(x)))
        return F.when(~end, F.array(w)).otherwise(_let(singular(w), changed))
    bare = F.rtrim(x, F.lit("."))
    return F.when(x.rlike(_PLAIN_WORD) & _untouched(bare), _let(bare, word)).otherwise(tokenize(x))


def line_tokens(label: Column) -> Column:
    """Distinct tokens of a tag line."""
    return F.array_distinct(F.flatten(F.transform(F.array_distinct(expand_strings(label)), tokens)))


def tokenize_state(x: Column) -> Column:
    """Like ``tokenize`` but keeps the ``d`` flags (for convergence checks)."""
    init = F.array(_entry(x, False))
    rounds = F.sequence(F.lit(1), F.length(x) * 2 + 8)
    return F.aggregate(rounds, init,
                       lambda acc, i: F.when(F.forall(acc, lambda e: e["d"]), acc).otherwise(_round(acc)))


def not_stop_word(token: Column) -> Column:
    """English stop-word test, case-insensitive (hash set lookup)."""
    return ~F.lower(token).isin(C.ENGLISH_STOP_WORDS)


# ---- keys, formats and small scalar helpers --------------------------------

def tag_file_key(path: Column) -> Column:
    """Image key of a tag file path: last path part, text before the first
    '.', text after the last 'tags'."""
    last = F.element_at(F.split(path, "/"), -1)
    stem = F.get(F.split(last, "\\."), 0)
    return F.element_at(F.split(stem, "tags"), -1)


def image_number(name: Column) -> Column:
    """'im999' -> 999 (second piece of a split on 'im'); null if not a number."""
    return F.get(F.split(name, "im"), 1).try_cast("bigint")


def url_base_name(url: Column) -> Column:
    """Base name of an image URL: last path part up to its first '.'."""
    return F.get(F.split(F.element_at(F.split(url, "/"), -1), "\\."), 0)


def classification_line(url: Column, label: Column, prob: Column) -> Column:
    """'url|label|pct' with the percentage to two decimals."""
    return F.concat_ws("|", url, label, F.format_string("%.2f", prob * F.lit(100.0)))


def hit_rate(hits: Column, total: Column) -> Column:
    """Percentage rounded half-up to two decimals; null when total is 0."""
    return F.floor(hits.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 10000 + 0.5) / 100


def rescale(value: Column, lo: Column, hi: Column, out_lo: float = 12.0, out_hi: float = 100.0) -> Column:
    """Linear map of [lo, hi] onto [out_lo, out_hi]; out_lo when hi == lo."""
    span = (hi - lo).cast("double")
    return F.when(span == 0, F.lit(out_lo)).otherwise(out_lo + (out_hi - out_lo) * (value - lo) / span)
