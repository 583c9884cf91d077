"""Patterns and string helpers.

The semantics to match are those of ECMAScript regular expressions: word characters are ASCII, white space includes the
no-break space and its relatives, ``$`` is the very end, and the case-insensitive flag also folds umlauts. Java differs in
all four, so word boundaries are spelled as look-arounds, white space as one class, the end as ``\\z`` and
the flag as ``(?iu)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space class.
WS = r"\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
S = f"[{WS}]"
#: The same characters, and those of them beyond ASCII as a class of their own.
WS_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
RARE = r"[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

B0 = "(?<![A-Za-z0-9_])"
B1 = "(?![A-Za-z0-9_])"
#: A boundary after a character that isn't an ASCII word character: a word character must follow.
BW = "(?=[A-Za-z0-9_])"

# The grammar's patterns.
GAEB = r"\d{2}\.\d{2}\.\d{4}"
ROOM = r"[A-ZÄÖÜ][A-ZÄÖÜ0-9]"
CODE_LINE = rf"^({GAEB}|{ROOM}(?:\.\d{{2}}){{2,4}})"
POSITION = rf"^({GAEB}){S}+(.*)\z"
POSITION_ROOM = rf"^({ROOM}(?:\.\d{{2}}){{4}}){S}*(.*)\z"
GROUP = rf"^(\d{{2}}\.\d{{2}}){S}+(.*)\z"
GROUP_ROOM = rf"^({ROOM}(?:\.\d{{2}}){{1,2}}){S}+(.*)\z"
TITLE = rf"^(\d{{2}}){S}+(.+)\z"
LEGEND = rf"(?iu)^H{S}|laufende Nr|definiert die Obergruppe|Obergruppenunter"
QUANTITY = rf"(?iu)^([\d.,]+){S}*((?:St|Stk|psch|pausch|m2|lfm|kg|Stck|Stück|h|Pa){B1}|(?:m²|m³){BW})"
RECAP = rf"(?iu)^(summe|zusammenstellung|übertrag){B1}"
LEADER = rf"^[.{WS}]+\z"
COLUMN_HEAD = rf"^OZ{B1}"
PRICE_HEAD = "Einheitspreis|Gesamtbetrag"
VOID_TEXT = f"(?iu){B0}entfällt{B1}"
EQUIVALENT_DE = f"(?iu){B0}oder gleichwertig{B1}"
EQUIVALENT = f"(?iu){B0}oder gleichwertig{B1}|{B0}or equivalent{B1}"
SECTION_WORDS = rf"(?iu)^(installation|testing|maintenance|dismantl[A-Za-z0-9_]*|specification|delivery|warranty|scope|requirements?|general|payment|insurance|health|safety|submission){B1}"
ITEM_NUMBER = rf"^(\d{{1,2}})[.)]{S}+(.{{3,}})\z"
ITEM_BULLET = rf"^[•·▪◦*\x{{2010}}-\x{{2015}}-]{S}+(.{{3,}})\z"
MUST = f"(?iu){B0}muss{B1}|{B0}mindest|{B0}zwingend|{B0}must{B1}|{B0}required{B1}|{B0}shall{B1}"
SHOULD = f"(?iu){B0}soll{B1}|{B0}möglichst{B1}|{B0}should{B1}|{B0}expected{B1}"
OPTIONAL = rf"(?iu){B0}optional{B1}|{B0}nice to have{B1}|{B0}ca\.{BW}|{B0}richtwert{B1}"
MODAL = f"(?iu){B0}(muss|müssen|sind zu|hat zu|verpflichtet|shall|must|is to be|are to be|required){B1}"
MODALITY_LEGEND = r"(?iu)(Mindest|Muss|zwingend)[^\n]{0,200}"
INTERNAL_REF = rf'Position{S}+["„“»«]([^"„“»«]{{2,50}})["„“»«]'
EXTERNAL_REF = rf"(?iu){B0}(Grundriss[A-Za-z0-9_]*|Montageplan[A-Za-z0-9_]*|Protokoll[A-Za-z0-9_]*|Terminplan[A-Za-z0-9_]*|Bestandsm[A-Za-z0-9_]*|Ansichtszeichn[A-Za-z0-9_]*|Beilage[A-Za-z0-9_]*)"
#: Language markers, for lower-case text; the first look-ahead only saves time.
GERMAN = "(?=[dglmsu])(?<![a-z0-9_])(?:(?:und|der|die|das|liefern|montieren|stück)(?![a-z0-9_])|gemäß(?=[a-z0-9_]))"
ENGLISH = "(?=[acimst])(?<![a-z0-9_])(?:the|and|shall|must|contractor|installation)(?![a-z0-9_])"
BROKEN_LIGATURE = f"[a-z] (?:on|ng|ed|ce|er|ts){B1}"
ARTIFACT = "�|Æ|ﬁ|ﬂ"

# Page kinds.
PAGE_TOC = "inhaltsverzeichnis|table of contents"
PAGE_RECAP = rf"zusammenstellung|summe{S}|gesamtbetrag|mwst|{B0}ust{B1}|übertrag"
PAGE_SUMS = f"summe|zusammenstellung|übertrag|mwst|{B0}ust{B1}"
PAGE_PREAMBLE = "vorbemerkungen|vertragstexte|background|general conditions|gegenstand der ausschreibung"
PAGE_POSITION = rf"(?m)^{S}*{GAEB}"
PAGE_COLUMNS = rf"{B0}OZ{B1}.*Menge.*Einheit"
PAGE_NUMBERED = rf"(?m)^{S}*\d+\.{S}+[A-Z]"
PAGE_PROSE = "(?iu)installation|maintenance|specification|dismantl|testing"
PAGE_FORM = "contractor details|checklist|tick|please complete|einzutragen"


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def spaced(c: Column) -> Column:
    """Runs of white space become one space. Few texts have any white space beyond ASCII; the others need no wide class."""
    rare = (F.octet_length(c) != F.length(c)) & c.rlike(RARE)
    return F.when(rare, F.regexp_replace(c, f"{S}+", " ")).otherwise(F.regexp_replace(c, r"[\t\n\x0B\f\r ]{2,}|[\t\n\x0B\f\r]", " "))


def collapse(c: Column) -> Column:
    """Runs of white space become one space, the ends go."""
    return F.btrim(spaced(c))


def clean_label(c: Column) -> Column:
    """Trailing dots and white space go, then runs of white space become one space."""
    return collapse(F.regexp_replace(c, rf"[.{WS}]+\z", ""))


def normal_line(c: Column) -> Column:
    """The key by which repeated lines are counted: digits are #, white space one space, lower case."""
    return F.lower(F.btrim(spaced(F.regexp_replace(c, "[0-9]+", "#"))))


def first_sentence(c: Column) -> Column:
    found = F.regexp_extract(c, rf"\A(.{{0,140}}?[.!?](?:{S}|\z))", 1)
    return trim(F.when(found != "", found).otherwise(F.substring(c, 1, 140)))


def tokens(c: Column, least: int) -> Column:
    """Distinct words of at least ``least`` letters or digits, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"[a-zäöüß0-9]{{{least},}}"), F.lit(0)))


def ordered_join(order: list[Column], text: Column, by: str) -> Column:
    """Aggregate: ``text`` joined in the order of ``order``; collect_list alone keeps no order after a shuffle."""
    rows = F.sort_array(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], text.alias("text"))))
    return F.array_join(F.transform(rows, lambda x: x["text"]), by)
