"""HTML to Markdown-ish text as a corpus job (T11). Table rows become
``| a | b |`` lines, which ``pages.normalize_table`` completes.

A chain of native ``regexp_replace`` / ``replace`` expressions, evaluated in
one projection with whole-stage codegen. Patterns stay in the Java/RE2
common subset (no back-references, no look-around).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blocks dropped with their content.
DROP_BLOCKS = ["head", "script", "style", "nav", "footer"]
# Entities decoded ('&amp;' last so '&amp;lt;' stays '&lt;').
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
            ("&ldquo;", "“"), ("&rdquo;", "”"), ("&hellip;", "…"), ("&bull;", "•"), ("&euro;", "€"), ("&reg;", "®"),
            ("&trade;", "™"), ("&deg;", "°"), ("&#34;", '"'), ("&#38;", "&"), ("&#60;", "<"), ("&#62;", ">"),
            ("&#160;", " "), ("&#8211;", "–"), ("&#8212;", "—"), ("&#8216;", "‘"), ("&#8217;", "’"), ("&#8220;", "“"),
            ("&#8221;", "”"), ("&#8226;", "•"), ("&#8230;", "…"), ("&#8364;", "€"), ("&amp;", "&")]

# Ordered (pattern, replacement) steps; replacements contain no group refs.
STEPS: list[tuple[str, str]] = (
    [(rf"(?is)<{t}[^>]*>.*?</{t}\s*>", "") for t in DROP_BLOCKS]
    + [(r"(?s)<!--.*?-->", "")]
    + [(rf"(?i)<h{n}[^>]*>", "\n" + "#" * n + " ") for n in range(1, 7)]
    + [(r"(?i)</h[1-6]\s*>", "\n"),
       (r"(?i)<li(\s[^>]*)?>", "\n* "),
       (r"(?i)<t[dh](\s[^>]*)?>", "| "),
       (r"(?i)</t[dh]\s*>", " "),
       (r"(?i)</tr\s*>", "|\n"),
       (r"(?i)<br\s*/?>", "\n"),
       (r"(?i)</?(p|div|ul|ol|li|article|section|tr|table|body|html)(\s[^>]*)?>", "\n"),
       (r"<[^>]*>", "")]
)
TIDY: list[tuple[str, str]] = [(r"[ \t]+", " "), (r"\n ", "\n"), (r" \n", "\n"), (r"\n{3,}", "\n\n")]


def html_to_text(html) -> Column:
    c = F.col(html) if isinstance(html, str) else html
    for pat, rep in STEPS:
        c = F.regexp_replace(c, pat, rep)
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    for pat, rep in TIDY:
        c = F.regexp_replace(c, pat, rep)
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def html_to_text_sql(col: str) -> str:
    """DuckDB twin of :func:`html_to_text` (same steps, same order)."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def lit(s: str) -> str:
        return " || chr(10) || ".join(q(p) for p in s.split("\n"))

    e = col
    for pat, rep in STEPS:
        e = f"regexp_replace({e}, {q(pat)}, {lit(rep)}, 'g')"
    for ent, ch in ENTITIES:
        e = f"replace({e}, {q(ent)}, {q(ch)})"
    for pat, rep in TIDY:
        e = f"regexp_replace({e}, {q(pat)}, {lit(rep)}, 'g')"
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"
