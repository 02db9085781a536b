"""DuckDB SQL text for the tag-normalisation functions (oracle side).

Generated from the same rule tables as ``tagloom.functions.text`` so both
engines apply identical patterns.  Dialect changes only: RE2 has no
look-ahead, so ``(?![a-z])(.*)`` becomes ``((?:[^a-z].*)?)`` under a whole
match; groups are written ``\\1``; accents go through ``strip_accents`` and
the same mark/modifier class as on the Spark side.
"""

from __future__ import annotations

import re

from ..functions import constants as C


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _duck_pattern(p: str) -> str:
    return p.replace("(?![a-z])(.*)", "((?:[^a-z].*)?)")


def _duck_repl(r: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", r)


def java_trim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _hangul(x: str) -> str:
    """Hangul syllables as conjoining letters, by their arithmetic."""
    n = "(unicode(c) - 44032)"
    letters = (f"chr(4352 + {n} // 588) || chr(4449 + {n} % 588 // 28) || "
               f"CASE WHEN {n} % 28 = 0 THEN '' ELSE chr(4519 + {n} % 28) END")
    return (f"CASE WHEN regexp_matches({x}, '[가-힣]') THEN array_to_string(list_transform(string_split({x}, ''), "
            f"lambda c: CASE WHEN c >= '가' AND c <= '힣' THEN {letters} ELSE c END), '') ELSE {x} END")


def _stripped(x: str) -> str:
    return f"strip_accents(lower({java_trim(x)}))"


def _unmarked(x: str) -> str:
    return f"regexp_replace({x}, '[\\p{{M}}\\p{{Lm}}\\p{{Sk}}]+', '', 'g')"


def fold(x: str) -> str:
    """Without Hangul, whose arithmetic would be written out dozens of times in
    the recursive tokeniser and make it many times slower."""
    return _unmarked(_stripped(x))


def fold_hangul(x: str) -> str:
    return _unmarked(_hangul(_stripped(x)))


def singular(x: str) -> str:
    parts = [f"CASE WHEN regexp_matches({x}, {q('(^|[^a-z0-9_])(' + '|'.join(C.UNCOUNTABLE_WORDS) + ')$')}) THEN {x}"]
    for pattern, repl in C.SINGULAR_RULES:
        parts.append(f" WHEN regexp_matches({x}, {q(pattern)}) THEN regexp_replace({x}, {q(pattern)}, {q(_duck_repl(repl))})")
    parts.append(f" ELSE {x} END")
    return "".join(parts)


def rewrite(x: str) -> str:
    parts = ["CASE"]
    for _, pattern, repl in C.REWRITE_RULES:
        p = _duck_pattern(pattern)
        if repl == C.DOT_TO_SPACE:
            value = f"replace({x}, '.', ' ')"
        elif repl == C.DASH_TO_SPACE:
            value = f"replace({x}, '-', ' ')"
        else:
            value = f"regexp_replace({x}, {q('^(?:' + p + ')$')}, {q(_duck_repl(repl))})"
        parts.append(f" WHEN regexp_full_match({x}, {q(p)}) THEN {value}")
    parts.append(f" ELSE {x} END")
    return "".join(parts)


def clean(x: str) -> str:
    c = f"replace({x}, '&amp;', '&')"
    c = f"translate({c}, {q(C.PUNCTUATION)}, {q(' ' * len(C.PUNCTUATION))})"
    c = f"replace({c}, '..', '')"
    c = f"replace({c}, '--', '-')"
    c = f"regexp_replace({c}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
    return f"regexp_replace({c}, '^bw$', 'b&w')"


def split_words(x: str) -> str:
    return f"list_filter(string_split({java_trim(x)}, ' '), lambda t: length(t) > 1)"


def rewrite_split(x: str) -> str:
    return split_words(clean(rewrite(x)))


def stop_words_list() -> str:
    return "[" + ", ".join(q(w) for w in C.ENGLISH_STOP_WORDS) + "]"


def tokens_cte(lines_sql: str) -> str:
    """CTE chain ending in ``tok(image, token)``: the tokeniser fixpoint over
    distinct words as a recursive query, joined back to the tag lines.

    ``lines_sql`` must yield (image, label) rows.
    """
    return f"""
raw_lines AS ({lines_sql}),
l_norm AS (SELECT image, label, {rewrite_split(singular(fold('label')))} AS w FROM raw_lines),
l_kids AS (
  SELECT image, unnest(CASE WHEN len(w) = 1 AND w[1] = label THEN [label]
                            WHEN len(w) = 1 THEN {rewrite_split('w[1]')}
                            ELSE w END) AS word
  FROM l_norm),
kids AS (SELECT DISTINCT image, word FROM l_kids),
words AS (SELECT DISTINCT word FROM kids),
rec(root, s, d) AS (
  SELECT word, word, false FROM words
  UNION
  SELECT root,
         unnest(CASE WHEN len(w) = 1 AND w[1] = s THEN [s]
                     WHEN len(w) = 1 THEN {rewrite_split('w[1]')}
                     ELSE w END),
         len(w) = 1 AND w[1] = s
  FROM (SELECT root, s, {rewrite_split(singular(fold('s')))} AS w FROM rec WHERE NOT d) AS step
),
word_tokens AS (SELECT DISTINCT root AS word, s AS token FROM rec WHERE d),
tok AS (SELECT DISTINCT k.image, t.token FROM kids k JOIN word_tokens t ON k.word = t.word)"""


def normalized_tags_cte(lines_sql: str) -> str:
    """``tokens_cte`` plus ``tags(image, label_normalized)``: stop words removed, distinct."""
    return tokens_cte(lines_sql) + f""",
tags AS (SELECT DISTINCT image, token AS label_normalized FROM tok
         WHERE NOT list_contains({stop_words_list()}, lower(token)))"""
