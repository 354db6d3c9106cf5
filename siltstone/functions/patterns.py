"""The word lists, literals and patterns whose exact form decides results.

Patterns are Java's.  ``(?d)`` makes ``.``, ``^`` and ``$`` know the line feed only; ``(?U)`` makes
``\\d``, ``\\w`` and ``\\s`` cover Unicode.
"""

# --- dialogue utterances
REPLY_TAG = r"(?d)回复 *@.*?: *"
HASHTAG = r"(?d)#.*?# *"
MENTION = r"@[0-9a-zA-Z\u4E00-\u9FA5\-_]+"
PHONE_11 = r"(?U)\D\d{11}\D"
QQ = r"(?U)[qQ]{2,}\d{5,12}\D"
SHORT_LINK = r"(?U)(?:(?:https?:?//|ftp://|www\d{0,3}\.)t\.cn?(/[a-zA-Z0-9]{0,8})?)|([网页链接|])"
PHONE_MASK = "<PHONE>"
EMAIL_MASK = "<EMAIL>"

#: A web address: a protocol or www, perhaps a user, a public IPv4 address or a host name with a top-level
#: domain or localhost, perhaps a port and a path that ends at a closing bracket, white space or a CJK character.
#: In the host part, the escapes of the original range stand for themselves: backslash, u, digits and the range 1-\.
_HOST_CHARS = r"a-z\\u00a1-\\\\uffff0-9"
#: Labels of a host: any, one whose first run is a single character, and the beginning of one that can be the last.
#: The repeats are possessive, so that a host of any length needs no stack; what they give up could never match.
_HOST_RUN = "[" + _HOST_CHARS + "]"
_LABEL = f"{_HOST_RUN}++(?:-{_HOST_RUN}++)*+"
_SHORT_LABELS = rf"(?:\.{_HOST_RUN}(?!{_HOST_RUN})(?:-{_HOST_RUN}++)*+)*+"
_LAST = rf"{_SHORT_LABELS}\.{_HOST_RUN}{{2}}"
URL = (
    r"(?iuU)(?:^|(?<![A-Za-z0-9/]))"
    r"(?:https?:?//|ftp://|www\d{0,3}\.)"
    r"(?:\S+@)?"
    r"(?:"
    r"(?!(?:10|127)(?:\.\d{1,3}){3})(?!(?:169\.254|192\.168)(?:\.\d{1,3}){2})(?!172\.(?:1[6-9]|2\d|3[0-1])(?:\.\d{1,3}){2})"
    r"(?:[1-9]\d?|1\d\d|2[01]\d|22[0-3])(?:\.(?:1?\d{1,2}|2[0-4]\d|25[0-5])){2}\.(?:[1-9]\d?|1\d\d|2[0-4]\d|25[0-4])"
    # labels as long as one follows that can be the last, then the first characters of that one
    r"|" + _LABEL + r"(?:" + _SHORT_LABELS + r"\." + _LABEL + r"(?=" + _LAST + r"))*+" + _LAST + _HOST_RUN + r"*+"
    r"|localhost"
    r")"
    r"(?::\d{2,5})?"
    r"(?:/[^)\]}\s\u4e00-\u9fa5]*)?"
)

#: Literals that are deleted from an utterance, in this order.
UTTERANCE_LITERALS = ("[图片]", "［图片］", "{ n楷体 s14}", "{ }", "{\\1c&H4080FF&}", "我擦", "\u200b", "查看动图", "评论配图")
#: A conversation with any of these is dropped.
INTERFACE_WORDS = ("图片评论", "分享图片", "直播回放")
FLOOR_WORD = "盖楼"

CJK = r"[\u4E00-\u9FA5]"
#: Characters that do not count when an utterance is tested for content.
NO_CONTENT = r"[a-zA-Z0-9零一二三四五六七八九十壹贰叁肆伍陆柒捌玖拾佰仟]+"

# --- general clean-text step (addresses and numbers in running text)
PLAIN_URL = r"(?iU)(?:https?://|ftp://|www\d{0,3}\.)[^\s<>\"']+"
PLAIN_EMAIL = r"(?iU)(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)++"
PLAIN_PHONE = r"(?<![\w.])(?:\+?\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3,4}[ .-]?\d{4}(?!\w)"

# --- web lines
ESCAPE = r"(?d)\\u.{4}"
SIMPLE_TAGS = r"<br>|<b>|<li>|<ol>|<blockquote>"
DOT_RUN = r"\.{6,}"
#: Blanks a line.  The bracketed words are sets of characters: a closing tag of one such character matches.
MARKUP = r"(?dU)<\s*[script|html|style|div][^>]*>.*?<\s*/\s*[script|html|style|div]\s*>"
COMMENT = r"(?is)<[ ]*!--.*?--[ ]*>"
REPEAT = r"(?d)(.+?)\1\1+"
#: Emoji and symbol ranges; the literal ``*``, ``#`` and the enclosing keycap belong to the class.
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2500}-\x{2BEF}\x{1F926}-\x{1F937}\x{10000}-\x{10FFFF}\u2640-\u2642\u2600-\u2B55\u200d\u23cf\u23e9\u231a\ufe0f\u3030*\u20e3#]+"

# --- corpus-specific lines
BOOK_LINES = (
    r"(?dm)^Published by.*$",
    r"(?dm)^Copyright.*$",
    r"(?dm)^Edited by.*$",
    r"(?dm)^Smashwords [eE]dition.*$",
    r"(?dm)^All rights reserved.*$",
    r"(?dmU)^(?:Part|PART|Chapter|CHAPTER) (?:I+|i+|\d+)(?::.*)?$",
    r"(?dm)^ISBN.*$",
    r"(?dm)^[# \-*]+$",
)
CATEGORY_LINE = r"(?dm)^Category:.*$"
BROKEN_LINK, MARKDOWN_LINK, CUT_LINK = r"(?s)(https?://[^ ]+?-)\n", r"\[([^\]]*)\]\(([^)]*)\)", r"https?://[^ ]+\.\.\."
USER_BREAK, POST_BREAK = r"(?U)\n(?:~~~|======|------)\n[\w\-]+\n", "===POSTBREAK==="
FOOTNOTE, SITE_LINK = r"(?dmU)^\[\d+\]:? .*$", r"<https?://[^>]*>"
TOC_NUMBER, NOTE_REFERENCE, STAR_LINE = r"(?dmU)[ ]{4,}[\d\-]+$", r"(?U)\[\d+\]", r"(?dm)^[* ]+$"
NOVEL_LINES = (r"(?dmiuU)^\s*\[Illustration.*$", r"(?dmiuU)^\s*Produced by .*$", r"(?dmiuU)^\s*Copyright .*$")
NOVEL_PARAGRAPHS = ("Project Gutenberg", "Transcriber's note")
NOVEL_END = r"(?s)End of the Project Gutenberg EBook.*$"
NOVEL_SEPARATORS = (r"(?dmU)^\s*\*+\s*$", r"(?dmU)^\s*(\*\s )\*\s*$")
#: Chapter marks; any line of one word goes too.
NOVEL_HEADS = r"(?dmiuU)^\s*((part|section|chapter) )?([\w\-]+)\s*$"
STAGE_LINE, QUOTED_LINE = r"(?dm)^\[(.*)\]$", r"(?dm)^\"(.*)\"$"

#: Which clean-up a file's name asks for.
CORPORA = {"novels": ("Gutenberg",), "subtitles": ("OpenSubtitles",), "encyclopedia": ("Wikipedia",), "news_forum": ("HackerNews",), "books": ("BookCorpusFair", "bookcorpus/orig"), "mathematics": ("DM_Mathematics",), "answers": ("StackExchange",)}
