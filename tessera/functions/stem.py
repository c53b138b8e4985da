"""The Spanish stemmer of the Snowball family as a column expression.

A word is looked at through three regions: R1 (after the first consonant that
follows a vowel), R2 (the same inside R1) and RV (see :func:`regions`).  Five
steps take endings off that lie in their region: attached pronouns, standard
endings, verb endings in y, other verb endings, and what is left of a vowel.
The regions are places in the word, so they hold for every shorter form of it.

Each step is a few regular expressions on the JVM.  It is meant for a table of
distinct words (see ``operators.vocabulary``), not for every occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import _col, let

# --- fixed values: vowels and endings of the published algorithm -------------------
VOWEL = "[aeiouáéíóúü]"
CONSONANT = "[^aeiouáéíóúü]"
PRONOUN = "me|se|sela|selo|selas|selos|la|le|lo|las|les|los|nos"
BEFORE_PRONOUN = "iéndo|ándo|ár|ér|ír|ando|iendo|yendo|ar|er|ir"
#: Endings of step 1 with what may precede them, all in R2; "amente" is told apart.
STANDARD = (
    ("anzas?|ic[oa]s?|ismos?|[ai]bles?|istas?|os[oa]s?|[ai]mientos?", "", ""),
    ("adoras?|adores|ador|aci[oó]n|aciones|antes?|ancias?", "", "ic"),
    ("logías?", "log", ""),
    ("ución|uciones", "u", ""),
    ("encias?", "ente", ""),
    ("mente", "", "ante|[ai]ble"),
    ("idad|idades", "", "abil|ic|iv"),
    ("iv[oa]s?", "", "at"),
)
AMENTE, BEFORE_AMENTE = "amente", "(?:at)?iv|os|ic|ad"
VERB_Y = "ya|ye|yan|yen|yeron|yendo|yo|yó|yas|yes|yais|yamos"
VERB_SHORT = "en|es|éis|emos"
VERB = (
    "arían|arías|arán|arás|aríais|aría|aréis|aríamos|aremos|ará|aré|erían|erías|erán|erás|eríais|ería|eréis|eríamos|eremos|erá|eré|"
    "irían|irías|irán|irás|iríais|iría|iréis|iríamos|iremos|irá|iré|aba|ada|ida|ía|ara|iera|ad|ed|id|ase|iese|aste|iste|an|aban|ían|"
    "aran|ieran|asen|iesen|aron|ieron|ado|ido|ando|iendo|ió|ar|er|ir|as|abas|adas|idas|ías|aras|ieras|ases|ieses|ís|áis|abais|íais|"
    "arais|ierais|aseis|ieseis|asteis|isteis|ados|idos|amos|ábamos|íamos|imos|áramos|iéramos|iésemos|ásemos"
)
RESIDUAL, RESIDUAL_E = "os|a|o|á|í|ó", "e|é"
ACCENTED, PLAIN = "áéíóú", "aeiou"

ALL_STANDARD = "|".join([AMENTE, *(endings for endings, _, _ in STANDARD)])


def ending(word: Column, endings: str) -> Column:
    """The longest of ``endings`` that ``word`` ends in, or nothing."""
    return F.regexp_extract(word, f"(?:{endings})$", 0)


def cut(word: Column, tail: Column) -> Column:
    return F.left(word, F.length(word) - F.length(tail))


def regions(word: Column) -> Column:
    """Struct of the places where R1, R2 and RV begin, counted from 0.

    RV begins after the next vowel if the second letter is a consonant, after
    the next consonant if the first two are vowels, and else after the third
    letter; a region that is not there begins at the end of the word."""
    def after(text, pattern):
        found = F.length(F.regexp_extract(text, pattern, 0))
        return F.when(found > 0, found).otherwise(F.length(text))

    first = f"^.*?{VOWEL}{CONSONANT}"
    rv = f"^(?:.{CONSONANT}+{VOWEL}|{VOWEL}{{2,}}{CONSONANT}|{CONSONANT}{VOWEL}.)"
    return let(after(word, first), lambda r1: F.struct(
        r1.alias("r1"), (r1 + after(F.substr(word, r1 + 1), first)).alias("r2"), after(word, rv).alias("rv")))


def without_pronoun(word: Column, at: Column) -> Column:
    """Step 0: an attached pronoun goes after a gerund or infinitive in RV,
    which loses its accent."""
    def after_verb(head, verb):
        there = (verb != "") & (F.length(head) - F.length(verb) >= at["rv"]) & ((verb != "yendo") | F.endswith(head, F.lit("uyendo")))
        return F.when(there, F.concat(cut(head, verb), F.translate(verb, ACCENTED, PLAIN))).otherwise(word)

    def after_head(head):
        return let(ending(head, BEFORE_PRONOUN), lambda verb: after_verb(head, verb))

    return let(ending(word, PRONOUN), lambda tail: F.when(tail == "", word).otherwise(let(cut(word, tail), after_head)))


def without_standard(word: Column, at: Column) -> Column:
    """Step 1: endings of nouns, adjectives and adverbs."""
    def less(head, endings):  # endings that lie in R2 whole
        tail = F.substr(head, at["r2"] + 1)
        return F.concat(F.left(head, at["r2"]), F.regexp_replace(tail, f"(?:{endings})$", "")) if endings else head

    def by_tail(tail, head):
        place = F.length(head)
        out = F.when((tail == AMENTE) & (place >= at["r1"]), less(head, BEFORE_AMENTE))
        for endings, instead, before in STANDARD:
            left = F.concat(head, F.lit(instead)) if instead else less(head, before)
            out = out.when(tail.rlike(f"^(?:{endings})$") & (place >= at["r2"]), left)
        return out.otherwise(word)

    return let(ending(word, ALL_STANDARD), lambda tail: F.when(tail == "", word).otherwise(
        let(cut(word, tail), lambda head: by_tail(tail, head))))


def without_verb(word: Column, at: Column) -> Column:
    """Steps 2a and 2b: verb endings in RV."""
    region = F.substr(word, at["rv"] + 1)

    def in_y(tail):
        head = cut(word, tail)
        return F.when((tail != "") & F.endswith(head, F.lit("u")), head).otherwise(F.lit(None))

    def other(tail):
        head = cut(word, tail)
        shorter = F.when(F.endswith(head, F.lit("gu")), F.left(head, F.length(head) - 1)).otherwise(head)
        return F.when(tail.rlike(f"^(?:{VERB_SHORT})$"), shorter).otherwise(head)

    return let(let(ending(region, VERB_Y), in_y), lambda head: F.when(head.isNotNull(), head).otherwise(
        let(ending(region, f"{VERB}|{VERB_SHORT}"), other)))


def without_residual(word: Column, at: Column) -> Column:
    """Step 3: a last vowel or ``os`` in RV."""
    def drop(tail):
        head = cut(word, tail)
        gu = tail.rlike(f"^(?:{RESIDUAL_E})$") & F.endswith(head, F.lit("gu")) & (F.length(head) > at["rv"])
        return F.when(gu, F.left(head, F.length(head) - 1)).otherwise(head)

    return let(ending(F.substr(word, at["rv"] + 1), f"{RESIDUAL}|{RESIDUAL_E}"), drop)


def spanish_stem(word: Column | str) -> Column:
    """Stem of a Spanish word, lower-cased first; null gives null."""
    def steps(w):
        def from_regions(at):
            def verbs(bare):
                # an ending of step 1 always changes the word
                return let(without_standard(bare, at), lambda s: F.when(s != bare, s).otherwise(without_verb(bare, at)))

            return let(let(without_pronoun(w, at), verbs), lambda s: F.translate(without_residual(s, at), ACCENTED, PLAIN))

        return let(regions(w), from_regions)

    return let(F.lower(_col(word)), steps)
