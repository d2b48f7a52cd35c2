"""Spanish stems by the published suffix-stripping rules, for the words of a table."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.session import tasks_for

VOWELS = "aeiouáéíóúü"
_PLAIN = str.maketrans("áéíóú", "aeiou")

# The endings of the public Spanish rules, by what is done with them.
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
GERUNDS = {"iéndo": "iendo", "ándo": "ando", "ár": "ar", "ér": "er", "ír": "ir", "ando": "ando", "iendo": "iendo", "ar": "ar", "er": "er", "ir": "ir"}
PLAIN_ENDINGS = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
AFTER_IC = "adora ador ación adoras adores aciones ante antes ancia ancias"
REPLACED = {"logía": "log", "logías": "log", "ución": "u", "uciones": "u", "encia": "ente", "encias": "ente"}
BEFORE = {"mente": "ante able ible", "idad": "abil ic iv", "idades": "abil ic iv", "iva": "at", "ivo": "at", "ivas": "at", "ivos": "at"}
Y_ENDINGS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
GU_ENDINGS = "en es éis emos"
VERB_ENDINGS = """
arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré
irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían
aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais
arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"""


def _longest(endings) -> re.Pattern:
    words = endings.split() if isinstance(endings, str) else list(endings)
    return re.compile(f"(?:{'|'.join(sorted(words, key=len, reverse=True))})$")


_VOWEL, _CONSONANT, _VOWEL_END = (re.compile(p) for p in (f"[{VOWELS}]", f"[^{VOWELS}]", f"[{VOWELS}][^{VOWELS}]"))
_PRONOUN = _longest(PRONOUNS)
_GERUND, _Y, _GU, _VERB = _longest(GERUNDS), _longest(Y_ENDINGS), _longest(GU_ENDINGS), _longest(VERB_ENDINGS + " " + GU_ENDINGS)
_STANDARD = _longest([*PLAIN_ENDINGS.split(), *AFTER_IC.split(), *REPLACED, *BEFORE, "amente"])
_RESIDUE = _longest("os a o á í ó e é")


def _after(word: str, start: int) -> int:
    """Where the part behind the first consonant that follows a vowel begins."""
    m = _VOWEL_END.search(word, start)
    return m.end() if m else len(word)


def _verb_region(word: str) -> int:
    if len(word) < 3:
        return len(word)
    if word[1] not in VOWELS:
        m = _VOWEL.search(word, 2)
    elif word[0] in VOWELS:
        m = _CONSONANT.search(word, 2)
    else:
        return 3
    return m.end() if m else len(word)


def _without_pronoun(word: str, rv: int) -> str:
    m = _PRONOUN.search(word)
    if not m or m.start() < rv:
        return word
    head = word[: m.start()]
    g = _GERUND.search(head)
    if g and g.start() >= rv:
        return head[: g.start()] + GERUNDS[g.group()]
    return head if head.endswith("uyendo") and len(head) - 5 >= rv else word


def _without_standard(word: str, r1: int, r2: int) -> str:
    m = _STANDARD.search(word)
    if not m:
        return word
    ending, at = m.group(), m.start()

    def also(head: str, parts: str) -> str:
        """Without one of these parts as well, if it lies in the second region."""
        p = _longest(parts).search(head)
        return head[: p.start()] if p and p.start() >= r2 else head

    if at < (r1 if ending == "amente" else r2):
        return word  # a shorter ending is not tried
    head = word[:at]
    if ending == "amente":
        shorter = also(head, "iv")
        return also(shorter, "at") if shorter != head else also(head, "os ic ad")
    if ending in REPLACED:
        return head + REPLACED[ending]
    before = "ic" if ending in AFTER_IC.split() else BEFORE.get(ending)
    return also(head, before) if before else head


def _without_verb(word: str, rv: int) -> str:
    m = _Y.search(word, rv)
    if m and word[m.start() - 1 : m.start()] == "u":
        return word[: m.start()]
    m = _VERB.search(word, rv)
    if not m:
        return word
    head = word[: m.start()]
    return head[:-1] if _GU.fullmatch(m.group()) and head.endswith("gu") else head


def _without_residue(word: str, rv: int) -> str:
    m = _RESIDUE.search(word, rv)
    if not m:
        return word
    head = word[: m.start()]
    return head[:-1] if m.group() in "eé" and head.endswith("gu") and len(head) - 1 >= rv else head


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a word in lower case, with its accents; what has no Spanish ending loses its accents only."""
    rv, r1 = _verb_region(word), _after(word, 0)
    r2 = _after(word, r1)
    word = _without_pronoun(word, rv)
    shorter = _without_standard(word, r1, r2)
    if shorter == word:
        shorter = _without_verb(word, rv)
    return _without_residue(shorter, rv).translate(_PLAIN)


def stem_words(words: DataFrame, word: str = "termino") -> DataFrame:
    """The rows of a table with ``raiz``, the stem of a word, beside it; rows without a word are left out. Rows do not move for it: a batch stems each of its words once."""

    @F.pandas_udf("string")
    def stems(batch: pd.Series) -> pd.Series:
        return batch.map({w: stem(w) for w in batch.unique()})

    return words.filter(F.col(word).isNotNull()).withColumn("raiz", stems(word))


def by_stem(postings: DataFrame) -> DataFrame:
    """``termino, id, tf, dl`` with stems for words; the postings of a document that have one stem are added up, in the task that gets the document."""
    rows = stem_words(postings).select(F.col("raiz").alias("termino"), "id", "dl", "tf").repartition(tasks_for(postings), "id", "dl")
    return rows.groupBy("termino", "id", "dl").agg(F.sum("tf").alias("tf")).select("termino", "id", "tf", "dl")
