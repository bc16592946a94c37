"""Text cleaning and key normalisation."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Texts that stand for "no value" in the source data.
MISSING_MARKERS = ("", "nan", "none", "null")

# Length limit of a logged message.
MESSAGE_LIMIT = 2000

# Unicode white space plus the four separator control characters. Removal and
# folding use ``translate`` and ``btrim``: a regular-expression class over
# these characters costs several times more per character.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_CONTROL = "".join(chr(c) for c in range(0x20) if chr(c) not in "\t\n\r") + "\x7f"
_TO_BLANK = "".join(c for c in _SPACES if c not in _CONTROL)


def strip_space(col: Column) -> Column:
    """Strip Unicode white space at both ends (plain ``trim`` only knows U+0020)."""
    return F.btrim(col, F.lit(_SPACES))


def safe_str(col: Column) -> Column:
    """Stripped text, NULL when it is empty or a missing-value marker."""
    text = strip_space(col.cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_MARKERS), text)


def clean_text(col: Column, max_len: int | None = None) -> Column:
    """Drop control characters, fold white space, optionally cut; '' is NULL.

    Control characters have no counterpart in the ``translate`` target and
    vanish, other white space becomes a blank, then runs of blanks shrink."""
    blanks = F.translate(col.cast("string"), _TO_BLANK + _CONTROL, " " * len(_TO_BLANK))
    text = F.trim(F.regexp_replace(blanks, " {2,}", " "))
    if max_len:
        text = F.substring(text, 1, max_len)
    return F.nullif(text, F.lit(""))


def clean_safe(col: Column) -> Column:
    return clean_text(safe_str(col))


@lru_cache(maxsize=None)
def _fold_tables(form: str) -> tuple[str, str]:
    """``translate`` arguments derived from the Unicode database: characters
    that decompose to one base character, then bare combining marks (which
    ``translate`` deletes because they have no counterpart)."""
    plain, bases, marks = [], [], []
    for code in range(0x80, min(0x10000, sys.maxunicode)):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.combining(char):
            marks.append(char)
            continue
        kept = "".join(c for c in unicodedata.normalize(form, char) if not unicodedata.combining(c))
        if kept != char and len(kept) == 1:
            plain.append(char)
            bases.append(kept)
    return "".join(plain + marks), "".join(bases)


def strip_accents(col: Column, form: str = "NFKD") -> Column:
    """Remove accents with one ``translate``. Compatibility characters that
    expand to several letters (ligatures) need ``strip_accents_full``."""
    source, target = _fold_tables(form)
    return F.translate(col, source, target)


@F.pandas_udf(StringType())
def strip_accents_full(texts: pd.Series) -> pd.Series:
    """Complete NFKD folding, Arrow-batched."""

    def fold(text):
        if text is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))

    return texts.map(fold)


def normalize_key(col: Column) -> Column:
    """Slug: lower case, no accents, runs of other characters become '_'."""
    text = strip_accents(F.lower(strip_space(col)))
    return F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def theme_key(col: Column) -> Column:
    """Accent-insensitive letters-only key of a theme name."""
    return F.regexp_replace(strip_accents(F.lower(col), "NFD"), "[^a-z]", "")


def normalize_cnpj_cpf(col: Column) -> Column:
    digits = F.translate(safe_str(col), ".-/" + _SPACES, "")
    return F.nullif(digits, F.lit(""))


def message(col: Column) -> Column:
    return F.substring(F.coalesce(col, F.lit("")), 1, MESSAGE_LIMIT)


def json_text(*cols: str | Column) -> Column:
    """Record as JSON text; accents stay as they are."""
    return F.to_json(F.struct(*cols))


def theme_text(nome: Column, descricao: Column) -> Column:
    return F.concat(nome, F.lit(": "), F.coalesce(F.nullif(descricao, F.lit("")), nome))


def proposition_text(tipo: Column, ementa: Column) -> Column:
    return F.concat(tipo, F.lit(": "), ementa)


def contains_folded(parts: list[Column], needle: str) -> Column:
    """Case-folded search in the concatenation of the parts."""
    return F.lower(F.concat(*[F.coalesce(p, F.lit("")) for p in parts])).contains(needle.lower())


# The prompt template (sections and placeholders).
PROMPT_SYSTEM = """\
Voce e um analista senior de Relacoes Governamentais.
Sua tarefa e resumir uma proposicao legislativa em ate 3 linhas,
em linguagem clara e direta para um executivo de empresa regulada.

Nao use jargao juridico desnecessario. Nao opine. Nao invente.
Se a ementa for muito curta ou ambigua, resuma o que estiver disponivel.

---"""
PROMPT_USER = '''\
Proposicao ({tipo}):
"""
{ementa}
"""

Resumo executivo (max. 3 linhas):'''
PROMPT_DEFAULT_TIPO = "Proposicao"


def prompt_sections(template: str) -> dict[str, str]:
    """Split a prompt file at its '## System' / '## User' headings."""
    sections: dict[str, list[str]] = {"system": [], "user": []}
    current = None
    for line in template.splitlines():
        heading = line.strip().removeprefix("## ").lower()
        if line.strip().startswith("## ") and heading in sections:
            current = heading
        elif current:
            sections[current].append(line)
    return {name: "\n".join(lines).strip() for name, lines in sections.items()}


def render_prompt(tipo: Column, ementa: Column, template: str = PROMPT_USER) -> Column:
    kind = F.coalesce(F.nullif(tipo, F.lit("")), F.lit(PROMPT_DEFAULT_TIPO))
    with_kind = F.replace(F.lit(template), F.lit("{tipo}"), kind)
    return F.replace(with_kind, F.lit("{ementa}"), ementa)
