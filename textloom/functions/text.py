"""Text columns built from Spark's own functions; nothing here leaves the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- fixed values --------------------------------------------------------------
# Question for the training set; TOPIC stands for the post's topic.
TRAINING_QUESTION = (
    'Write technical blog that demonstrates knowledge and best practice for "TOPIC" and its '
    "technical advantage and describes code snippest from the piece of information in the text "
    "bellow: "
)
TOPIC_MARK = "TOPIC"
# Prompt of the retrieval chain.
CHAIN_TEMPLATE = (
    "Write technical blog that demonstrates knowledge and best practice for {input} and its "
    "technical advantage and describes code snippest from the piece of information in the text "
    "bellow: {context} "
)
SYSTEM_MESSAGE = (
    "You are a technical blog writer. You will write a blog post about a specific technology."
)
# Instruction for a chat model that distils a file; {text} stands for the file.
DISTIL_INSTRUCTION = (
    "## Instruction\n"
    "    Given the text which could be a code snippet, summarise the text. The summary is detailed"
    " and explains technical terms and implementation.\n"
    "    The summary should include examples and code snippets. Before summary context, the output"
    " must include header of the text and keywords and technical terms. The output should only"
    " contain header, keywords and summary.\n"
    "\n"
    "    ## Given Text\n"
    "    {text}\n"
    "    "
)
# -- end of fixed values -------------------------------------------------------

ASCII_SPACE = " \t\n\x0b\f\r"

_MARKUP = (
    # what is never closed ends with the text, so that the search for its end is made once
    r"(?is)<!--(?:.*?-->|.*)"
    r"|<(script|style|template)\b[^>]*>(?:.*?</\1\s*>|.*)"
    r"|</?[a-z](?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    r"|</?[a-z][^>]*>"
    r"|<[!?][^>]*>"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, also when used inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_space(col: Column) -> Column:
    """Without white space at either end (`trim` alone takes blanks only)."""
    return F.trim(col, F.lit(ASCII_SPACE))


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML page: text nodes side by side, as they stand.

    Comments, declarations and the content of script, style and template
    elements are dropped; character references are decoded.
    """
    return let(F.regexp_replace(html, _MARKUP, ""), decode_entities)


def decode_entities(text: Column) -> Column:
    """Decode HTML character references in one pass, so `&amp;lt;` gives `&lt;`."""
    pieces = F.split(text, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), _decode_after_ampersand), ""),
    )
    return F.when(F.instr(text, "&") > 0, decoded).otherwise(text)


def _literal_map(values: dict[str, str]) -> Column:
    # one literal, parsed once when the plan is optimised
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _decode_after_ampersand(piece: Column) -> Column:
    frequent = {n: html5[n] for n in ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")}
    named = {n: c for n, c in html5.items() if n.endswith(";")}
    bare = {n: c for n, c in html5.items() if not n.endswith(";")}

    name = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]*;", 0)
    by_name = F.coalesce(
        F.try_element_at(_literal_map(frequent), name), F.try_element_at(_literal_map(named), name)
    )
    longest_first = "|".join(sorted(bare, key=len, reverse=True))
    bare_name = F.regexp_extract(piece, f"^(?:{longest_first})", 0)
    by_bare_name = F.try_element_at(_literal_map(bare), bare_name)

    number = F.regexp_extract(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    digits = F.ltrim(F.regexp_extract(number, r"([0-9a-fA-F]+);?$", 1), F.lit("0"))
    code = (
        F.when(F.length(digits) > 9, 0)  # beyond Unicode, as is 0
        .when(number.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("long"))
        .otherwise(digits.try_cast("long"))
    )

    def replaced(character: Column, reference: Column) -> Column:
        return F.concat(character, F.substr(piece, F.length(reference) + 1))

    return (
        F.when(number != "", replaced(_character(F.coalesce(code, F.lit(0))), number))
        .when(by_name.isNotNull(), replaced(by_name, name))
        .when(by_bare_name.isNotNull(), replaced(by_bare_name, bare_name))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def _character(code: Column) -> Column:
    # references 128-159 mean Windows-1252 characters, as browsers read them
    windows = {}
    for number in range(128, 160):
        try:
            windows[str(number)] = bytes([number]).decode("cp1252")
        except UnicodeDecodeError:
            windows[str(number)] = chr(number)
    unusable = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0"))
    return (
        F.when(unusable, F.lit("�"))
        .when(code.between(128, 159), F.try_element_at(_literal_map(windows), code.cast("string")))
        .otherwise(F.decode(utf32, "UTF-32"))
    )


def utf8_text(content: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 are left out, a U+FFFD that is really there stays.

    While bad bytes are taken out, such a character is written as NUL and 1, and NUL as two NULs.
    """
    bad, nul, kept = F.lit("\ufffd"), "\x00", F.lit("\x00\x01")
    hidden = F.replace(F.replace(content.cast("string"), F.lit(nul), F.lit(nul * 2)), bad, kept)
    pieces = F.split(F.replace(F.make_valid_utf8(hidden), bad, F.lit("")), nul * 2)
    return F.array_join(F.transform(pieces, lambda piece: F.replace(piece, kept, bad)), nul)


def parent_folder(path: Column) -> Column:
    """The path without its last segment; a path without a slash stays."""
    return F.regexp_replace(path, "/[^/]+$", "")


def linked_html_path(path: Column, post_id: Column) -> Column:
    """Where the HTML of a post lies, seen from the CSV file that lists the post."""
    return F.concat_ws("", parent_folder(path), F.lit("/posts/"), post_id, F.lit(".html"))


def path_in_store(path: Column, marker: str = ".net/") -> Column:
    """The path after the first `marker`, that is relative to the store's root (up to a second marker, if any)."""
    return F.split_part(path, F.lit(marker), F.lit(2))


def remove_blanks(text: Column) -> Column:
    """Without U+0020; tabs and line ends stay."""
    return F.replace(text, F.lit(" "), F.lit(""))


def notebook_text(content: Column) -> Column:
    """Sources of a notebook's cells, in order, one line end between cells.

    A cell's source may be one string or a list of lines.
    """
    return F.array_join(_cell_sources(content), "\n")


def _cell_sources(content: Column) -> Column:
    lines = F.from_json(content, "cells array<struct<source:array<string>>>")["cells"]
    whole = F.from_json(content, "cells array<struct<source:string>>")["cells"]
    return F.transform(
        F.arrays_zip(lines.alias("lines"), whole.alias("whole")),
        lambda c: F.coalesce(
            F.array_join(c["lines"]["source"], ""), c["whole"]["source"], F.lit("")
        ),
    )


#: Terminal colours in the lines of an error.
_COLOUR = r"\x1b\[[0-9;]*[A-Za-z]"


def _either(value: Column, path: str, between: str = "") -> Column:
    """Text at a path of a variant that is one string or a list of strings; null if it is neither."""
    return F.coalesce(
        F.array_join(F.try_variant_get(value, path, "array<string>"), between), F.try_variant_get(value, path, "string")
    )


def _output_text(output: Column) -> Column:
    """What a cell's output says: text of a stream, plain text of a result, or the lines of an error."""
    error = F.coalesce(
        F.nullif(_either(output, "$.traceback", "\n"), F.lit("")),
        F.concat_ws(": ", F.try_variant_get(output, "$.ename", "string"), F.try_variant_get(output, "$.evalue", "string")),
    )
    return (
        F.when(F.try_variant_get(output, "$.output_type", "string") == "error", F.regexp_replace(error, _COLOUR, ""))
        .otherwise(F.coalesce(_either(output, "$.text"), _either(output, "$.data['text/plain']"), F.lit("")))
    )


def notebook_outputs(content: Column) -> Column:
    """Per cell of a notebook the texts of its outputs, in order; pictures and the like have none.

    Outputs differ in shape, so they are read as variants. Null where the text is no notebook.
    """
    cells = F.try_variant_get(F.try_parse_json(content), "$.cells", "array<variant>")
    outputs = lambda cell: F.coalesce(F.try_variant_get(cell, "$.outputs", "array<variant>"), F.array())
    return F.transform(
        cells, lambda cell: F.filter(F.transform(outputs(cell), _output_text), lambda text: text != "")
    )


def notebook_with_outputs(content: Column) -> Column:
    """Sources and outputs of a notebook's cells, in order, one line end between them."""
    said = lambda source, outputs: F.concat_ws("\n", F.array(source), outputs)
    return F.array_join(F.zip_with(_cell_sources(content), notebook_outputs(content), said), "\n")


def token_count(text: Column) -> Column:
    """Number of tokens when text is cut at every single white-space character.

    Empty tokens inside and at the start count, those at the end do not; an
    empty text is one empty token, a blank one has none, null counts 0.
    """
    pieces = F.split(F.rtrim(text, F.lit(ASCII_SPACE)), r"\s")
    return (
        F.when(text.isNull(), 0)
        .when(text == "", 1)
        .when(text.rlike(r"\S"), F.size(pieces))
        .otherwise(0)
    )


def words(text: Column) -> Column:
    """Lower-case words between white space, without empty ones."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def sentences(text: Column) -> Column:
    """Cut after `.`, `?` or `!` where white space follows."""
    return F.split(F.regexp_replace(text, r"([.?!])\s+", "$1\u001f"), "\u001f")


def topic(title: Column, subtitle: Column) -> Column:
    """Title and subtitle with a blank between; a null part is left out."""
    return F.concat_ws(" ", title, subtitle)


def fill(template: str, **values: Column) -> Column:
    """The template with each mark replaced by its column, wherever it occurs.

    The template is cut at the marks first, so a mark inside a value stays as
    it is. A null value makes the result null.
    """
    parts: list[str | Column] = [template]
    for mark, value in values.items():
        cut: list[str | Column] = []
        for part in parts:
            if isinstance(part, str):
                first, *rest = part.split(mark)
                cut.append(first)
                for text in rest:
                    cut += [value, text]
            else:
                cut.append(part)
        parts = cut
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts if not (isinstance(p, str) and p == "")])


def topic_question(topic_text: Column, template: str = TRAINING_QUESTION) -> Column:
    """The training question about a topic."""
    return fill(template, **{TOPIC_MARK: topic_text})


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_record(query: Column, answer: Column, system: str = SYSTEM_MESSAGE) -> Column:
    """One training conversation: preamble, question with context, answer."""
    return F.array(
        message("System", F.lit(system)), message("User", query), message("Chatbot", answer)
    )


def chain_prompt(request: Column, context: Column, template: str = CHAIN_TEMPLATE) -> Column:
    """System and user message for one request with its retrieved context."""
    user = fill(template, **{"{input}": request, "{context}": context})
    return F.array(message("system", F.lit(SYSTEM_MESSAGE)), message("user", user))


def last_message(messages: Column) -> Column:
    """Content of the last message, whoever wrote it."""
    return F.element_at(messages, -1)["content"]
