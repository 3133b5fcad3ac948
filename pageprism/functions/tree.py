"""Element tree of a page inside the row, built by JVM expressions.

A page becomes markup tokens and texts; one fold over them keeps the open elements and writes an element down when it closes. Elements are
numbered in document order and carry their parent and the number of their last descendant, so that "is inside", "is a child of" and
"comes behind" are tests on numbers. The fold runs in two levels (a block of tokens, then the blocks), because appending to one long array would copy it
for every token.

End tags that HTML lets authors leave out are added by the rules of the standard: a start tag closes the elements that can't hold
it, up to an element that shields them; an end tag closes the nearest open element of its name, and with it all inside.
"""

from __future__ import annotations

from pyspark.sql import Column

from pageprism.functions.binding import column, each, fresh, let, only, q
from pageprism.functions.markup_text import _ATTRS
from pageprism.functions.text import plain_references_sql, unescape_kept_sql, unescape_sql

# Element names of the HTML standard.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
RAW = "script style title textarea".split()
SCOPE = "applet caption html table td th marquee object template".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
CLOSE_P = ("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
           "hgroup hr main menu nav ol p pre search section summary table ul").split()
#: Start tag -> (open elements that it closes, elements that shield those outside of them).
CLOSED_BY = {
    "li": (["li"], ["ul", "ol", "menu", *SCOPE]),
    "dt": (["dt", "dd"], ["dl", *SCOPE]),
    "dd": (["dt", "dd"], ["dl", *SCOPE]),
    "option": (["option"], ["select", "datalist", *SCOPE]),
    "optgroup": (["option", "optgroup"], ["select", *SCOPE]),
    "rt": (["rt", "rp"], ["ruby", *SCOPE]),
    "rp": (["rt", "rp"], ["ruby", *SCOPE]),
    "tr": (["tr", "td", "th", "caption", "colgroup"], ["table", "template", "html"]),
    "td": (["td", "th", "caption", "colgroup"], ["table", "template", "html"]),
    "th": (["td", "th", "caption", "colgroup"], ["table", "template", "html"]),
    "body": (["head"], ["html"]),
    "a": (["a"], SCOPE),
    "button": (["button"], SCOPE),
} | {t: (["tr", "td", "th", "tbody", "thead", "tfoot", "caption", "colgroup"], ["table", "template", "html"])
     for t in ("tbody", "thead", "tfoot", "caption", "colgroup")} | {t: (["p"], ["button", *SCOPE]) for t in CLOSE_P}
#: End tag -> elements that shield; all others by ``SCOPE``.
END_SCOPES = {t: ["table", "template", "html"] for t in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption")} | {
    "table": ["template", "html"], "template": ["html"], "body": ["html"], "html": [], "p": ["button", *SCOPE], "li": ["ul", "ol", *SCOPE]}

#: Elements this deep become siblings, as in browsers; bounds the open elements of a page without end tags.
MOST_OPEN = 512
#: Tokens of a block at most and at least: the root of their number, since each step copies what its block has written down.
BLOCK = 256
LEAST_BLOCK = 8

_NAME = r"^</?([a-zA-Z][^\s/>]*)"
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<[!?][^>]*+(?:>|\z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>]){_ATTRS}>.*?(?:</\1\s*>|\z)"
    rf"|<[a-z]{_ATTRS}>"
    r"|</?[a-z][^>]*+(?:>|\z)"
    r"|[^<]++"
    r"|<"
)
_START = rf"(?is)^<[a-z]{_ATTRS}>"
_RAW_END = rf"(?i)</(?:{'|'.join(RAW)})\s*>$"
_ATTRIBUTE = r"""(?s)[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+"""

PIECES = "array<struct<at:int,text:string>>"
FRAMES = f"array<struct<pos:int,parent:int,tag:string,src:string,pieces:{PIECES}>>"
#: ``pieces`` are the element's own texts, each with the number of elements that began before it.
TREE = f"array<struct<pos:int,parent:int,last:int,tag:string,attrs:map<string,string>,pieces:{PIECES}>>"
_DONE = f"array<struct<pos:int,parent:int,last:int,tag:string,src:string,pieces:{PIECES}>>"
_MARKS = "struct<kind:string,tag:string,src:string,text:string,closes:array<string>,shields:array<string>,outer:boolean>"


def _texts(values: list[str]) -> str:
    return f"array({', '.join(q(v) for v in values)})" if values else "CAST(array() AS ARRAY<STRING>)"


def _by_tag(tag: str, table: dict[str, list[str]], other: str) -> str:
    """Look-up of a list by tag; tags with equal lists share a case."""
    groups: dict[tuple, list[str]] = {}
    for name, values in table.items():
        groups.setdefault(tuple(values), []).append(name)
    cases = " ".join(f"WHEN {tag} IN ({', '.join(q(n) for n in names)}) THEN {_texts(list(values))}" for values, names in groups.items())
    return f"CASE {cases} ELSE {other} END"


def _marked(token: str) -> str:
    """Token as a struct: its kind (``s`` start tag, ``w`` whole element, ``e`` end tag, ``t`` text, null for others), tag, own text, and
    which open elements it closes."""
    none = _texts([])

    def made(kind: str, tag: str, text: str, closes: str, shields: str, outer: str) -> str:
        src = f"CASE WHEN {kind} IN ('s', 'w') THEN {plain_references_sql(f'regexp_extract({token}, {q(_START)}, 0)')} END"
        return (f"CAST(named_struct('kind', {kind}, 'tag', {tag}, 'src', {src}, 'text', {text}, 'closes', {closes}, "
                f"'shields', {shields}, 'outer', {outer}) AS {_MARKS})")

    def tagged(tag: str) -> str:
        inside = f"regexp_replace(regexp_replace({token}, {q(_START)}, ''), {q(_RAW_END)}, '')"
        decoded = f"CASE WHEN {tag} IN ('script', 'style') THEN {inside} ELSE {unescape_sql(inside)} END"
        whole = f"({tag} IN ({', '.join(q(t) for t in VOID + RAW)}) OR endswith({token}, '/>'))"
        start = made(f"CASE WHEN {whole} THEN 'w' ELSE 's' END", tag, f"CASE WHEN {tag} IN ({', '.join(q(t) for t in RAW)}) THEN {decoded} END",
                     _by_tag(tag, {t: c for t, (c, _) in CLOSED_BY.items()}, none),
                     _by_tag(tag, {t: s for t, (_, s) in CLOSED_BY.items()}, none), "true")
        end = made("'e'", tag, "NULL", f"array({tag})", _by_tag(tag, END_SCOPES, _texts(SCOPE)), "false")
        return f"CASE WHEN startswith({token}, '</') THEN {end} ELSE {start} END"

    text = made("'t'", "NULL", unescape_sql(token), none, none, "false")
    other = f"CAST(NULL AS {_MARKS})"
    closed = f"endswith({token}, '>')"  # a tag that the page cuts off is none
    return (f"CASE WHEN {token} RLIKE {q('^</?[a-zA-Z]')} THEN CASE WHEN {closed} OR {token} RLIKE {q(_START)} "
            f"THEN {let(f'lower(regexp_extract({token}, {q(_NAME)}, 1))', tagged)} ELSE {other} END "
            f"WHEN startswith({token}, '<!') OR startswith({token}, '<?') THEN {other} ELSE {text} END")


def _closed_count(stack: str, token: str) -> str:
    """How many of the open elements (innermost first) a token closes."""
    def among(tags: str) -> str:
        shield = f"CAST(array_position({each(tags, lambda t: f'array_contains({token}.shields, {t})')}, true) AS INT)"
        inside = let(shield, lambda s: f"CASE WHEN {s} = 0 THEN {tags} ELSE slice({tags}, 1, {s} - 1) END")
        # The shield of an end tag may be the element itself.
        return let(inside, lambda i: let(each(i, lambda t: f"array_contains({token}.closes, {t})"), lambda hits: (
            f"CASE WHEN NOT {token}.outer THEN CAST(array_position({hits}, true) AS INT) "
            f"WHEN array_contains({hits}, true) THEN size({hits}) - CAST(array_position(reverse({hits}), true) AS INT) + 1 ELSE 0 END")))

    return f"CASE WHEN size({token}.closes) = 0 THEN 0 ELSE {let(each(stack, lambda f: f'{f}.tag'), among)} END"


def _written(frame: str, last: str) -> str:
    return (f"named_struct('pos', {frame}.pos, 'parent', {frame}.parent, 'last', {last}, 'tag', {frame}.tag, 'src', {frame}.src, "
            f"'pieces', {frame}.pieces)")


def _state(n: str, stack: str, done: str) -> str:
    return f"named_struct('n', {n}, 'stack', {stack}, 'done', {done})"


def _step(state: str, token: str) -> str:
    """State after a token: number of elements so far, open elements (innermost first) and closed ones."""
    n, stack, done = f"{state}.n", f"{state}.stack", f"{state}.done"
    piece = f"array(named_struct('at', {n}, 'text', {token}.text))"
    top = f"{stack}[0]"
    longer = (f"named_struct('pos', {top}.pos, 'parent', {top}.parent, 'tag', {top}.tag, 'src', {top}.src, 'pieces', concat({top}.pieces, {piece}))")
    texted = _state(n, f"concat(array({longer}), slice({stack}, 2, {MOST_OPEN}))", done)

    def popped(k: str) -> str:
        gone = f"concat({done}, {each(f'slice({stack}, 1, {k})', lambda f: _written(f, f'{n} - 1'))})"
        rest = f"slice({stack}, {k} + 1, {MOST_OPEN})"
        opened = let(rest, lambda r: (
            f"CASE WHEN {token}.kind = 'w' THEN " + _state(f"{n} + 1", r, f"concat({gone}, array(named_struct('pos', {n}, 'parent', "
            f"coalesce(get({r}, 0).pos, -1), 'last', {n}, 'tag', {token}.tag, 'src', {token}.src, 'pieces', CASE WHEN {token}.text IS NULL THEN "
            f"CAST(array() AS {PIECES}) ELSE array(named_struct('at', {n} + 1, 'text', {token}.text)) END)))")
            + " ELSE " + _state(f"{n} + 1", f"concat(array(named_struct('pos', {n}, 'parent', coalesce(get({r}, 0).pos, -1), 'tag', {token}.tag, "
                                f"'src', {token}.src, 'pieces', CAST(array() AS {PIECES}))), {r})", gone) + " END"))
        return f"CASE WHEN {token}.kind <> 'e' THEN {opened} WHEN {k} = 0 THEN {state} ELSE {_state(n, rest, gone)} END"

    room = f"CASE WHEN {token}.kind = 's' THEN size({stack}) - {MOST_OPEN - 1} ELSE 0 END"
    return (f"CASE WHEN {token} IS NULL THEN {state} WHEN {token}.kind = 't' THEN CASE WHEN size({stack}) = 0 THEN {state} ELSE {texted} END "
            f"ELSE {let(f'greatest({_closed_count(stack, token)}, {room}, 0)', popped)} END")


def attributes_sql(src: str) -> str:
    """Attributes of a start tag as a map: names in small letters, '' without a value, the first of equal names."""
    bare = r"""(?s)^(["'])(.*)\1$"""

    def pair(a: str) -> str:
        raw = f"regexp_replace({a}, {q('(?s)^[^=]*+=?\\s*+')}, '')"
        return (f"named_struct('name', lower(regexp_extract({a}, {q('(?s)^([^\\s=]+)')}, 1)), "
                f"'value', {unescape_kept_sql(f'regexp_replace({raw}, {q(bare)}, {q('$2')})')})")

    inner = f"regexp_replace(regexp_replace({src}, {q('^<[a-zA-Z][^\\s/>]*+')}, ''), {q('/?>$')}, '')"
    pairs = each(f"regexp_extract_all({inner}, {q(_ATTRIBUTE)}, 0)", pair)
    return let(pairs, lambda p: f"map_from_entries(filter({p}, (a, i) -> NOT exists(slice({p}, 1, i), b -> b.name = a.name)))")


def tree_sql(html: str) -> str:
    """Elements of a page in document order, as an array of structs (``TREE``); empty for a page without elements, null for none."""
    state, block, number = fresh("s"), fresh("s"), fresh("i")
    token = fresh("t")
    empty = f"CAST(array() AS {_DONE})"

    def folded(tokens: str) -> str:
        return let(f"least({BLOCK}, greatest({LEAST_BLOCK}, CAST(sqrt(size({tokens})) AS INT)))", lambda width: in_blocks(tokens, width))

    def in_blocks(tokens: str, width: str) -> str:
        inner = (f"aggregate(slice({tokens}, {number} * {width} + 1, {width}), {_state(f'{state}.n', f'{state}.stack', empty)}, "
                 f"({block}, {token}) -> {_step(block, token)})")
        merged = let(inner, lambda b: _state(f"{b}.n", f"{b}.stack", f"concat({state}.done, array({b}.done))"))
        zero = _state("0", f"CAST(array() AS {FRAMES})", f"CAST(array() AS ARRAY<{_DONE}>)")
        blocks = f"sequence(0, CAST(floor(size({tokens}) / {width}) AS INT))"
        return f"aggregate({blocks}, {zero}, ({state}, {number}) -> {merged})"

    def finished(end: str) -> str:
        open_ = each(f"{end}.stack", lambda f: _written(f, f"{end}.n - 1"))
        return f"array_sort(concat(flatten({end}.done), {open_}), (x, y) -> x.pos - y.pos)"

    marks = only(each(f"regexp_extract_all({html}, {q(_TOKEN)}, 0)", _marked), lambda m: f"{m} IS NOT NULL")
    rows = let(let(marks, folded), finished)
    shown = each(rows, lambda e: (f"named_struct('pos', {e}.pos, 'parent', {e}.parent, 'last', {e}.last, 'tag', {e}.tag, "
                                  f"'attrs', {attributes_sql(f'{e}.src')}, 'pieces', {e}.pieces)"))
    return f"CASE WHEN {html} IS NOT NULL THEN {shown} END"


def own_text_sql(element: str) -> str:
    """Text of an element without that of its descendants."""
    return f"array_join({each(f'{element}.pieces', lambda p: f'{p}.text')}, '')"


def inner_text_sql(element: str, tree: str) -> str:
    """Text of an element and its descendants in document order. Of texts with equally many elements before them, those further inside
    come first."""
    pieces = each(f"slice({tree}, {element}.pos + 1, {element}.last - {element}.pos + 1)", lambda e: each(
        f"{e}.pieces", lambda p: f"named_struct('at', {p}.at, 'outward', -{e}.pos, 'text', {p}.text)"))
    ordered = f"array_sort(flatten({pieces}), (x, y) -> CASE WHEN x.at <> y.at THEN x.at - y.at ELSE x.outward - y.outward END)"
    return f"CASE WHEN {element}.pos = {element}.last THEN {own_text_sql(element)} ELSE array_join({each(ordered, lambda p: f'{p}.text')}, '') END"


# Where the HTML standard finds the value of a property.
URL_ATTRIBUTES = {"a": "href", "area": "href", "link": "href", "audio": "src", "embed": "src", "iframe": "src", "img": "src", "source": "src",
                  "track": "src", "video": "src", "object": "data", "meta": "content", "data": "value", "meter": "value", "time": "datetime"}


def _json_text(value: str) -> str:
    return let(f"to_json(array({value}))", lambda j: f"substr({j}, 2, length({j}) - 2)")


def microdata_sql(tree: str) -> str:
    """Top-level microdata items of a tree as JSON texts: ``@type``, ``@context`` and one key per property; several values make a list.

    A property belongs to the innermost item around it. Items are written from the last to the first, so those inside others are ready when their
    owner is written.
    """
    def scoped(scopes: str) -> str:
        around = lambda e: f"array_max({each(only(scopes, lambda s: f'{s}.pos < {e}.pos AND {s}.last >= {e}.pos'), lambda s: f'{s}.pos')})"

        def value(e: str) -> str:
            by_tag = " ".join(f"WHEN {e}.tag = {q(t)} THEN {q(a)}" for t, a in URL_ATTRIBUTES.items())
            given = (f"coalesce(nullif(try_element_at({e}.attrs, CASE {by_tag} ELSE 'content' END), ''), "
                     f"try_element_at({e}.attrs, 'content'))")
            return f"coalesce({given}, trim(regexp_replace({inner_text_sql(e, tree)}, {q('(?U)' + chr(92) + 's+')}, ' ')))"

        props = each(only(tree, lambda e: f"map_contains_key({e}.attrs, 'itemprop')"), lambda e: (
            f"named_struct('pos', {e}.pos, 'owner', {around(e)}, 'names', {only(f'''split({e}.attrs['itemprop'], {q(chr(92) + 's+')})''', lambda n: f'''{n} <> '' ''')}, "
            f"'item', map_contains_key({e}.attrs, 'itemscope'), 'json', CASE WHEN NOT map_contains_key({e}.attrs, 'itemscope') THEN {_json_text(value(e))} END)"))

        def items(p: str) -> str:
            ready, scope = fresh("m"), fresh("s")

            def written(own: str) -> str:
                pairs = (f"flatten({each(own, lambda x: each(f'{x}.names', lambda n: f'''named_struct('name', {n}, 'json', CASE WHEN {x}.item THEN {ready}[{x}.pos] ELSE {x}.json END)'''))})")

                def fields(named: str) -> str:
                    def field(name: str) -> str:
                        values = each(only(named, lambda x: f"{x}.name = {name}"), lambda x: f"{x}.json")
                        return let(values, lambda v: (f"concat({_json_text(name)}, ':', CASE WHEN size({v}) = 1 THEN {v}[0] "
                                                      f"ELSE concat('[', array_join({v}, ','), ']') END)"))

                    return each(f"array_distinct({each(named, lambda x: f'{x}.name')})", field)

                kind = f"trim(coalesce(try_element_at({scope}.attrs, 'itemtype'), ''))"
                typed = let(kind, lambda k: (
                    f"CASE WHEN NOT endswith({k}, '/') AND {k} <> '' THEN array(concat('\"@type\":', {_json_text(f'substring_index({k}, {q('/')}, -1)')}), "
                    f"concat('\"@context\":', {_json_text(f'''CASE WHEN contains({k}, '/') THEN substr({k}, 1, length({k}) - length(substring_index({k}, '/', -1)) - 1) ELSE '' END''')})) "
                    f"ELSE CAST(array() AS ARRAY<STRING>) END"))
                return f"concat('{{', array_join(concat({typed}, {let(pairs, fields)}), ','), '}}')"

            own = only(p, lambda x: f"{x}.owner = {scope}.pos")
            built = (f"aggregate(reverse({scopes}), CAST(map() AS MAP<INT, STRING>), ({ready}, {scope}) -> "
                     f"map_concat({ready}, map({scope}.pos, {let(own, written)})))")
            inside = each(only(p, lambda x: f"{x}.owner IS NOT NULL"), lambda x: f"{x}.pos")
            return let(built, lambda b: let(inside, lambda i: each(
                only(scopes, lambda s: f"NOT array_contains({i}, {s}.pos)"), lambda s: f"{b}[{s}.pos]")))

        return let(props, items)

    return let(only(tree, lambda e: f"map_contains_key({e}.attrs, 'itemscope')"), scoped)


def tree(html: str) -> Column:
    return column(tree_sql(html))
