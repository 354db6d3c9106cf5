"""Text clean-up as Column functions: each takes and gives a string column, null stays null.

They are plain expressions, so Catalyst fuses any chain of them into one pass without Python.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def gsub(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(by))


def delete(c: Column, *patterns: str) -> Column:
    for p in patterns:
        c = gsub(c, p)
    return c


def swap(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` where f uses its argument more than once: c is evaluated once and stands once in the plan."""
    return F.transform(F.array(c), f)[0]


def ustrip(c: Column) -> Column:
    """Strip all Unicode white space (``trim`` strips the space only)."""
    return gsub(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z")


def collapse_blanks(c: Column) -> Column:
    return gsub(c, " +", " ")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def unlines(c: Column) -> Column:
    return F.array_join(c, "\n")


# --- P: dialogue utterances


def remove_control(c: Column, keep_tab: bool = False) -> Column:
    """Delete all characters of Unicode category C."""
    return gsub(c, r"[\p{C}&&[^\t]]" if keep_tab else r"\p{C}")


def drop_reply_tag(c: Column) -> Column:
    return gsub(c, P.REPLY_TAG)


def drop_hashtag(c: Column) -> Column:
    return gsub(c, P.HASHTAG)


def drop_url(c: Column) -> Column:
    return gsub(c, P.URL)


def drop_short_link(c: Column, compat: bool = True) -> Column:
    """Delete short links.  With `compat`, single characters of the words for "web page" and "link" go as well."""
    return gsub(c, P.SHORT_LINK if compat else P.SHORT_LINK.split("|([")[0])


def drop_mention(c: Column) -> Column:
    return gsub(c, P.MENTION)


def mask_phone(c: Column) -> Column:
    """Mask eleven digits between two other characters, which go too."""
    return gsub(c, P.PHONE_11, P.PHONE_MASK)


def drop_qq(c: Column) -> Column:
    return gsub(c, P.QQ, " ")


def plain_clean(c: Column, url: str = " ", email: str = P.EMAIL_MASK, phone: str = P.PHONE_MASK, one_line: bool = False, lower: bool = True) -> Column:
    """Mask addresses and numbers in running text, lower-case it and normalise its white space."""
    c = gsub(gsub(gsub(c, P.PLAIN_URL, url), P.PLAIN_EMAIL, email), P.PLAIN_PHONE, phone)
    c = F.lower(c) if lower else c
    for mask in {email, phone} if lower else ():
        c = swap(c, mask.lower(), mask) if mask else c
    c = gsub(gsub(c, r"\r\n|\r", "\n"), r"(?U)\n\s*", " " if one_line else "\n")
    return ustrip(gsub(c, r"(?U)[\s&&[^\n]]+", " "))


def drop_literals(c: Column) -> Column:
    for x in P.UTTERANCE_LITERALS:
        c = swap(c, x, "")
    return c


def has_content(c: Column, script: str = P.CJK, ignored: str = P.NO_CONTENT) -> Column:
    """Has a character of `script`, and more than one character is left without runs of letters, digits and numerals."""
    return c.rlike(script) & (F.length(gsub(c, ignored)) > 1)


def normalize(c: Column, repair=None, convert=None) -> Column:
    """Repair and convert (if functions are given), tabs to spaces, no control characters, single blanks, stripped."""
    c = repair(c) if repair else c
    c = convert(c) if convert else c
    return ustrip(collapse_blanks(remove_control(swap(c, "\t", " "))))


def clean_utterance(c: Column, repair=None, convert=None, script: str = P.CJK) -> Column:
    """All utterance steps, in their order; "" if no content is left.  A null utterance is the text "None"."""
    c = normalize(F.coalesce(c, F.lit("None")), repair, convert)
    for step in (drop_reply_tag, drop_url, drop_short_link, drop_hashtag, drop_mention, drop_qq, mask_phone, plain_clean, drop_literals, collapse_blanks):
        c = step(c)
    return bind(c, lambda x: F.when(has_content(x, script), ustrip(x)).otherwise(""))


def ngrams(c: Column, n: int) -> Column:
    """All substrings of `n` characters, in order; none if the text is shorter.  One pass: each match looks ahead and takes one character."""
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def text_hash(c: Column) -> Column:
    """The first 8 bytes of SHA-1 as hexadecimal digits: equal where the 64-bit number is equal."""
    return F.substring(F.sha1(c), 1, 16)


def text_hash_number(c: Column) -> Column:
    """The same as a little-endian number."""
    return F.conv(F.concat(*[F.substring(F.sha1(c), 15 - 2 * i, 2) for i in range(8)]), 16, 10).cast("decimal(20,0)")


# --- R: web lines


def _ranges(points: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return out


def _class(ranges: list[list[int]]) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" if b > a else f"\\x{{{a:X}}}" for a, b in ranges) + "]"


@lru_cache(maxsize=1)
def gb2312_lacks() -> list[list[int]]:
    """Ranges of the code points that GB2312 lacks, from its 94 x 94 code table."""
    have = set(range(128))
    for row in range(0xA1, 0xF8):
        for cell in range(0xA1, 0xFF):
            try:
                have.add(ord(bytes((row, cell)).decode("gb2312")))
            except UnicodeDecodeError:
                pass
    ends = sorted(have)
    return [[a + 1, b - 1] for a, b in zip(ends, [*ends[1:], 0x110000]) if b - a > 1]


@lru_cache(maxsize=1)
def _gb2312_complement() -> str:
    """A pattern of one character that GB2312 lacks.

    Java tries the ranges of a class one by one, so ASCII is ruled out first, and then a block of 256 is
    looked for before its ranges.
    """
    wide = [[a, b] for a, b in gb2312_lacks() if b - a >= 256]
    narrow: dict[int, list[list[int]]] = {}
    for a, b in gb2312_lacks():
        if b - a < 256:
            for block in {a >> 8, b >> 8}:
                narrow.setdefault(block, []).append([max(a, block << 8), min(b, (block << 8) + 255)])
    parts = [f"(?={_class([[k << 8, (k << 8) + 255]])}){_class(v)}" for k, v in sorted(narrow.items())]
    return r"(?![\x00-\x7F])(?:" + "|".join([*parts[:1], _class(wide), *parts[1:]]) + ")"


def is_rare_char(c: Column) -> Column:
    return c.rlike("^" + _gb2312_complement())


def drop_unprintable(c: Column) -> Column:
    """Delete spelt-out escapes, then all characters that GB2312 lacks."""
    return delete(c, P.ESCAPE, _gb2312_complement())


def drop_simple_tags(c: Column) -> Column:
    return gsub(c, P.SIMPLE_TAGS)


def drop_dot_runs(c: Column) -> Column:
    return gsub(c, P.DOT_RUN)


def blank_markup(c: Column) -> Column:
    return bind(c, lambda x: F.when(x.rlike(P.MARKUP), "").otherwise(x))


def drop_comments(c: Column) -> Column:
    return gsub(c, P.COMMENT)


def remove_codes(c: Column, collapse=None) -> Column:
    """Tags, dot runs, repeats, markup, comments.  `collapse` replaces the backtracking pattern for repeats."""
    c = drop_dot_runs(drop_simple_tags(c))
    c = collapse(c) if collapse else gsub(c, P.REPEAT, "$1")
    return drop_comments(blank_markup(c))


def drop_emoji(c: Column) -> Column:
    return ustrip(gsub(c, P.EMOJI))


def clean_line(c: Column, convert=None, repair=None, collapse=None) -> Column:
    """Unprintable characters, codes, addresses and numbers, script conversion."""
    c = remove_codes(drop_unprintable(c), collapse)
    c = plain_clean(repair(c) if repair else c, url="", email="", one_line=True)
    return convert(c) if convert else c


def normalize_newlines(c: Column) -> Column:
    return swap(swap(c, "\r\n", "\n"), "\r", "\n")


def strip_trailing(c: Column) -> Column:
    return gsub(c, r"(?dm)[ \t]+$")


def collapse_newlines(c: Column) -> Column:
    """Two or more line feeds become two."""
    return gsub(c, r"\n{2,}", "\n\n")


def drop_book_lines(c: Column) -> Column:
    return delete(c, *P.BOOK_LINES)


def drop_markdown_links(c: Column) -> Column:
    c = gsub(gsub(c, P.BROKEN_LINK, "$1"), P.MARKDOWN_LINK, "$1")
    return strip_trailing(gsub(c, P.CUT_LINK))


def unindent(c: Column) -> Column:
    return gsub(c, r"(?dm)^ *")


def drop_toc(c: Column) -> Column:
    c = delete(c, P.TOC_NUMBER, P.NOTE_REFERENCE, P.STAR_LINE)
    return unlines(F.filter(lines(c), lambda x: ~F.contains(x, F.lit(" " * 5))))


def _paragraph(own: Column, most: int) -> Column:
    """The lines `own` of a paragraph as one text."""
    lead = F.regexp_extract(own[0], r"(?U)^[\s\x1c-\x1f]*", 0)

    def joined(x: Column) -> Column:
        own, lead = x["own"], x["lead"]
        rest = F.transform(own, lambda l: l.substr(F.length(lead) + 1, F.length(l)))
        fits = F.forall(own, lambda l: l.startswith(lead) & (F.length(l) <= most))
        flush = F.forall(rest, lambda l: ~l.rlike(r"(?U)^[\s\x1c-\x1f]"))
        uneven = F.size(F.array_distinct(F.transform(own, F.length))) != 1
        return F.when((F.size(own) > 1) & fits & flush & uneven, F.concat(lead, F.array_join(rest, " "))).otherwise(F.array_join(own, "\n"))

    return bind(F.struct(own.alias("own"), lead.alias("lead")), joined)


def unwrap(c: Column, most: int = 100) -> Column:
    """Join the lines of each paragraph whose lines are short, of one indentation and not all of one length."""
    return F.array_join(F.transform(F.split(c, "\n\n", -1), lambda p: bind(lines(p), lambda own: _paragraph(own, most))), "\n\n")


def strip_single_space(c: Column) -> Column:
    return gsub(c, r"\A (?! )")


def _without_paragraphs(c: Column, words: str) -> Column:
    return F.array_join(F.filter(F.split(c, "\n\n", -1), lambda p: ~F.contains(p, F.lit(words))), "\n\n")


def clean_novel(c: Column) -> Column:
    c = delete(unwrap(c), *P.NOVEL_LINES)
    for x in P.NOVEL_PARAGRAPHS:
        c = _without_paragraphs(c, x)
    c = F.array_join(F.transform(F.split(c, r"\n{3,}", -1), lambda p: swap(p, "\n\n", "\n")), "\n\n")
    c = delete(drop_toc(unindent(c)), P.NOVEL_END, *P.NOVEL_SEPARATORS, P.NOVEL_HEADS)
    return unlines(F.transform(lines(c), strip_single_space))


def drop_repeated_lines(c: Column) -> Column:
    """Of consecutive equal lines one stays."""
    return bind(lines(c), lambda own: unlines(F.filter(own, lambda x, i: (i == 0) | (x != F.get(own, i - 1)))))


def clean_subtitles(c: Column) -> Column:
    c = drop_repeated_lines(swap(swap(c, '" "', '"\n"'), '\n" ', '\n"'))
    return gsub(gsub(gsub(c, P.QUOTED_LINE, "$1"), P.STAGE_LINE), r"\n+", "\n")


def drop_category(c: Column) -> Column:
    return gsub(c, P.CATEGORY_LINE)


def trim_mathematics(c: Column) -> Column:
    """Without the first two lines and the last."""
    return bind(lines(c), lambda own: unlines(F.slice(own, 3, F.greatest(F.size(own) - 3, F.lit(0)))))


def expand_answers(c: Column) -> Column:
    return swap(swap(c, "Q:\n\n", "Question:\n"), "A:\n\n", "Answer:\n")


def clean_news_forum(c: Column, strict: bool = False) -> Column:
    """Posts of a forum: users, links, the second line (the address), quotes and foot notes go; paragraphs are joined.

    A text of one line raises an error if `strict`; else it has no second line to lose.
    """
    own = lines(drop_markdown_links(gsub(ustrip(c), P.USER_BREAK, f"\n{P.POST_BREAK}\n\n")))
    one = (lambda x: F.raise_error(F.lit("a post needs two lines")).cast("array<string>")) if strict else (lambda x: x)
    own = bind(own, lambda x: F.when(F.size(x) < 2, one(x)).otherwise(F.concat(F.slice(x, 1, 1), F.slice(x, 3, F.greatest(F.size(x) - 2, F.lit(0))))))
    own = F.transform(own, lambda x, i: F.when((i == 0) & F.contains(x, F.lit(" -")), gsub(x, r"(?s)\A(.*) -.*\z", "$1")).otherwise(x))
    c = unlines(F.filter(own, lambda x: ~x.startswith("> ")))
    c = unwrap(delete(c, P.FOOTNOTE, P.SITE_LINK), 1000)
    return swap(gsub(unindent(c), r"\n{2,}", "\n"), P.POST_BREAK, "")


def decode_escapes(c: Column) -> Column:
    """Read the text as the inside of a JSON string; null if it is none."""
    return F.from_json(F.concat(F.lit('["'), c, F.lit('"]')), "array<string>")[0]


def named(file: Column, corpus: str) -> Column:
    out = F.lit(False)
    for x in P.CORPORA[corpus]:
        out = out | F.contains(file, F.lit(x))
    return out


def fix_document(c: Column, file: Column, repair=None) -> Column:
    """The general clean-ups, and those that the file's name asks for."""
    only = lambda corpus, f, c: bind(c, lambda x: F.when(named(file, corpus), f(x)).otherwise(x))
    c = normalize_newlines(c)
    c = repair(c) if repair else c
    c = collapse_newlines(strip_trailing(only("novels", clean_novel, c)))
    for corpus, f in (("subtitles", clean_subtitles), ("encyclopedia", drop_category), ("news_forum", clean_news_forum), ("books", drop_book_lines), ("mathematics", trim_mathematics), ("answers", expand_answers)):
        c = only(corpus, f, c)
    return ustrip(collapse_newlines(c))


# --- F: predicates on one text


def is_number(c: Column) -> Column:
    """Reads as a floating-point number, with white space around it, digits grouped by underscores, nan and inf."""
    return c.rlike(r"(?iU)^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)\s*$")


#: Accepts one- and two-digit fields.
TIME_FORMAT = "yyyy-M-d-H-m-s"


def not_after(a: Column, b: Column) -> Column:
    return F.to_timestamp(a, TIME_FORMAT) <= F.to_timestamp(b, TIME_FORMAT)


def no_interface_words(c: Column) -> Column:
    out = F.lit(True)
    for w in P.INTERFACE_WORDS:
        out = out & ~F.contains(c, F.lit(w))
    return out


def joined_length(cont: Column, by: str = "") -> Column:
    return F.length(F.array_join(cont, by))
