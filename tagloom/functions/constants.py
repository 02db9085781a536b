"""Fixed values the results depend on.

Everything in the FIXED VALUES block must stay exactly as written: the expected
outputs are defined in terms of these lists.  The accent-folding map is derived
from a rule, never typed in.  Nothing is read from disk.
"""

from __future__ import annotations

import functools
import unicodedata

# --------------------------------------------------------------------------
# FIXED VALUES
# --------------------------------------------------------------------------

# Tags judged not significant for the "most common tags" report.
NON_SIGNIFICANT_TAGS = [
    "explore", "canon", "2007", "nikon", "mm", "50", "macro", "de", "365", "500",
    "2008", "photo", "100", "10", "40", "geotagged", "eo", "la", "san", "flickr",
    "400", "explored", "80", "200", "f1", "geolat", "geolon",
    "diamondclassphotographer", "photography", "hdr", "f2", "30", ".8", "07", "ef",
]

# Sentinel label and score of an image that could not be scored.
NONE_LABEL = "__None__"
NONE_SCORE = 1.0

# Characters the tag clean-up turns into spaces.
PUNCTUATION = "[]?¿!¡_()$+*/=:|\\,;#~"

# Ordered metadata rewrites of one tag.  Each pattern must match the whole
# string; the first one that does is applied.  Replacement "$n" refers to a
# group; the two special values replace every '.' or every '-' by a space.
DOT_TO_SPACE = "<dot>"
DASH_TO_SPACE = "<dash>"
REWRITE_RULES = [
    ("geolocation", r"(.*)(geo:)(lat|lon)(=)(-?[0-9]+?)(\.[0-9]{4,})(.*)", "$1geo$3$5$7"),
    ("emoticon", r"(.*)(:|;-?)(\)|\(|P|D)(?![a-z])(.*)", "$1emoticono$4"),
    ("decimal_comma", r"(.*[0-9])(,)([0-9].*)", "$1.$3"),
    ("f_number", r"(.*)(f\/?)([0-9]{1,5})(.*)", "$1 f$3 $4"),
    ("date_dots", r"(.*)([0-9]+)\.([0-9]+)\.([0-9]+)(.*)", "$1$2-$3-$4$5"),
    ("date_slashes", r"(.*)([0-9]+)\/([0-9]+)\/([0-9]+)(.*)", "$1$2-$3-$4$5"),
    ("camera", r"(.*)(canon)(.*)", "$1 $2 $3"),
    ("lens_range", r"([a-z]*)([0-9]{1,2}-[0-9]{2,3}mm)(.*)", "$1 $2 $3"),
    ("lens_packed", r"([a-z]*)([0-9]{2})([0-9]{2,3}mm)(.*)", "$1 $2-$3 $4"),
    ("aperture", r"(.*)(f[0-9]\.[0-9])(.*)", "$1 $2 $3"),
    ("letters_digits", r"(^[a-z]+?)([0-9].*)", "$1 $2"),
    ("digits_letters", r"(^[0-9]+?)([a-z].*)", "$1 $2"),
    ("letters_dot", r"(^[a-z]+?\.)(.*)", DOT_TO_SPACE),
    ("letters_dash", r"(^[a-z]+?\-)(.*)", DASH_TO_SPACE),
    ("dot_letter", r"(^\.+?[a-z])(.*)", DOT_TO_SPACE),
    ("dash_letter", r"(^\-+?[a-z])(.*)", DASH_TO_SPACE),
]

# English singular rules (the widely published inflection list), first match
# wins, applied to the end of the whole string.  A string whose last word is
# uncountable is left alone.
UNCOUNTABLE_WORDS = [
    "equipment", "information", "rice", "money", "species", "series", "fish",
    "sheep", "jeans", "police",
]
SINGULAR_RULES = [
    (r"(m)oves$", "$1ove"),
    (r"(s)exes$", "$1ex"),
    (r"(c)hildren$", "$1hild"),
    (r"(m)en$", "$1an"),
    (r"(p)eople$", "$1erson"),
    (r"(database)s$", "$1"),
    (r"(quiz)zes$", "$1"),
    (r"(matr)ices$", "$1ix"),
    (r"(vert|ind)ices$", "$1ex"),
    (r"^(ox)en", "$1"),
    (r"(alias|status)(es)?$", "$1"),
    (r"(octop|vir)(us|i)$", "$1us"),
    (r"^(a)x[ie]s$", "$1xis"),
    (r"(cris|test)(is|es)$", "$1is"),
    (r"(shoe)s$", "$1"),
    (r"(o)es$", "$1"),
    (r"(bus)(es)?$", "$1"),
    (r"^(m|l)ice$", "$1ouse"),
    (r"(x|ch|ss|sh)es$", "$1"),
    (r"(m)ovies$", "$1ovie"),
    (r"(s)eries$", "$1eries"),
    (r"([^aeiouy]|qu)ies$", "$1y"),
    (r"([lr])ves$", "$1f"),
    (r"(tive)s$", "$1"),
    (r"(hive)s$", "$1"),
    (r"([^f])ves$", "$1fe"),
    (r"(^analy)(sis|ses)$", "$1sis"),
    (r"((a)naly|(b)a|(d)iagno|(p)arenthe|(p)rogno|(s)ynop|(t)he)(sis|ses)$", "$1sis"),
    (r"([ti])a$", "$1um"),
    (r"(n)ews$", "$1ews"),
    (r"(ss)$", "$1"),
    (r"s$", ""),
]

# English stop words (Spark ML's published default list), removed from tags.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's "
    "would"
).split()

# Language code -> display name shown by the language histogram.
LANGUAGE_NAMES = [
    ("af", "Afrikáans"), ("am", "Amhárico"), ("an", "Aragonés"), ("ar", "Árabe"),
    ("as", "Asamés"), ("az", "Azerí"), ("be", "Bielorruso"), ("bg", "Búlgaro"),
    ("bn", "Bengalí"), ("br", "Bretón"), ("bs", "Bosnio"), ("ca", "Catalán"),
    ("cs", "Checo"), ("cy", "Galés"), ("da", "Danés"), ("de", "Alemán"),
    ("dz", "Dzongkha"), ("el", "Griego "), ("en", "Inglés"), ("eo", "Esperanto"),
    ("es", "Español "), ("et", "Estonio"), ("eu", "Euskera"), ("fa", "Persa"),
    ("fi", "Finés "), ("fo", "Feroés"), ("fr", "Francés"), ("ga", "Irlandés"),
    ("gl", "Gallego"), ("gu", "Guyaratí"), ("he", "Hebreo"), ("hi", "Hindi"),
    ("hr", "Croata"), ("ht", "Haitiano"), ("hu", "Húngaro"), ("hy", "Armenio"),
    ("id", "Indonesio"), ("is", "Islandés"), ("it", "Italiano"), ("ja", "Japonés"),
    ("jv", "Javanés"), ("ka", "Georgiano"), ("kk", "Kazajo"), ("km", "Camboyano"),
    ("kn", "Canarés"), ("ko", "Coreano"), ("ku", "Kurdo"), ("ky", "Kirguís"),
    ("la", "Latín"), ("lb", "Luxemburgués"), ("lo", "Lao"), ("lt", "Lituano"),
    ("lv", "Letón"), ("mg", "Malgache"), ("mk", "Macedonio"), ("ml", "Malayalam"),
    ("mn", "Mongol"), ("mr", "Maratí"), ("ms", "Malayo"), ("mt", "Maltés"),
    ("nb", "Noruego"), ("ne", "Nepalí"), ("nl", "Neerlandés"), ("nn", "Nynorsk"),
    ("no", "Noruego"), ("oc", "Occitano"), ("or", "Oriya"), ("pa", "Panyabí"),
    ("pl", "Polaco"), ("ps", "Pastún"), ("pt", "Portugués"), ("qu", "Quechua"),
    ("ro", "Rumano"), ("ru", "Ruso"), ("rw", "Ruandés"), ("se", "Sami"),
    ("si", "Cingalés"), ("sk", "Eslovaco"), ("sl", "Esloveno"), ("sq", "Albanés"),
    ("sr", "Serbio"), ("sv", "Sueco"), ("sw", "Suajili"), ("ta", "Tamil"),
    ("te", "Télugu"), ("th", "Tailandés"), ("tl", "Tagalo"), ("tr", "Turco"),
    ("ug", "Uigur"), ("uk", "Ucraniano"), ("ur", "Urdu"), ("vi", "Vietnamita"),
    ("vo", "Volapük"), ("wa", "Valón"), ("xh", "Xhosa"), ("zh", "Chino"),
    ("zu", "Zulú"),
]

# Job parameters of the reference workload.
MAX_SCORE_LABELS = 5       # labels kept per scored image
STREAM_LABELS = 3          # labels kept per streamed photo
LOT_SIZE = 200             # images per scoring lot
IMAGES_PER_INDEX = 25000   # images taken from one index listing
TOP_TAGS = 50              # most common tags / labels reported and modelled
TOP_TAGS_PREFILTER = 100   # rows looked at before dropping non-significant tags
VOCAB_SIZE = 10000         # bag-of-words vocabulary
TREE_DEPTH = 8             # depth of each one-vs-rest tree
TRAIN_PERCENT = 80         # hold-out split
RANKING_SIZE = 25          # live ranking of streamed labels
RECENT_PER_LABEL = 40      # latest distinct images shown per label
PIXEL_MEAN = 117.0         # input standardisation of the image model
PIXEL_SCALE = 1.0
# --------------------------------------------------------------------------
# END FIXED VALUES
# --------------------------------------------------------------------------


def _is_stripped_mark(ch: str) -> bool:
    cat = unicodedata.category(ch)
    return cat.startswith("M") or cat in ("Lm", "Sk") or 0x0300 <= ord(ch) <= 0x036F


# Hangul syllables decompose by rule: (leading, vowel, trailing) conjoining letters.
HANGUL_FIRST, HANGUL_LAST = "\uac00", "\ud7a3"
HANGUL_LEADING = [chr(0x1100 + i) for i in range(19)]
HANGUL_VOWELS = [chr(0x1161 + i) for i in range(21)]
HANGUL_TRAILING = [""] + [chr(0x11A8 + i) for i in range(27)]


@functools.lru_cache(maxsize=1)
def accent_fold_table() -> tuple[str, str]:
    """(source, target) for ``translate``: canonical decomposition with marks,
    modifier letters and modifier symbols removed, derived from ``unicodedata``
    for every code point.

    Characters that decompose to one remaining character map to it; those that
    decompose to nothing are deleted (they sit after the mapped part of
    ``source``).  Only Hangul syllables keep several characters; they are
    decomposed by rule (``functions.text.fold``).
    """
    src, dst, deleted = [], [], []
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        dec = unicodedata.normalize("NFD", ch)
        if dec == ch or HANGUL_FIRST <= ch <= HANGUL_LAST:
            continue
        kept = "".join(c for c in dec if not _is_stripped_mark(c))
        if len(kept) == 1:
            src.append(ch)
            dst.append(kept)
        elif not kept:
            deleted.append(ch)
        else:
            raise ValueError(f"U+{cp:04X} keeps {len(kept)} characters")
    return "".join(src) + "".join(deleted), "".join(dst)
