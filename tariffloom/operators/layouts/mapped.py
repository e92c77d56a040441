"""The main parser: rows under a header mapping, with an ordered list of salvage rules.

An ``Item`` is one row under one mapping. Rules run in order over the item;
each may set its price, code or pack, or drop it. What depends on several
rows (orientation of split rows, order in number stacks, codes that were once
"on request") is state of the ``MappedParser``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from . import cells
from .cells import LOWEST, Row
from .columns import at, described
from .headers import HeaderReader, Mapping
from .streams import pairs_in

_AMPERES = re.compile(r"\b\d+(?:\.\d+)?\s*A\b", re.I)
_LOOSE_GROUP = re.compile(r"\d{4,6}[ \t]\d{2,6}")
_PACK_CONTEXT = re.compile(r"\b(pack|packing|set(?:s)?|consisting|module(?:s)?|nos?\.?|pcs?\.?|pieces?)\b", re.I)
NEAR_COLUMNS, HOPS, OWN_HOPS, STACKS = 3, 3, 4, 8


class Dropped(Exception):
    """The item gives no row."""


@dataclass
class Item:
    row: list[str]
    at: int
    mapping: Mapping
    place: int
    numeric: bool
    code_cell: str
    price_cell: str
    text: str
    between: str
    pack_cell: str
    price: float | None = None
    code: str = ""
    text_code: str | None = None
    lead_code: str | None = None
    mixed: tuple[str, float] | None = None
    own_pack: str = ""
    evidence: bool = False

    @property
    def texts(self) -> list[str]:
        return [t for t in (self.text, self.between) if t]


class MappedParser:
    def __init__(self, rows: list[list[str]], mappings: list[Mapping], headers: HeaderReader, titles: list[str] | None, force_numeric: bool, include_particulars: bool, include_pack: bool):
        self.rows, self.mappings, self.include_particulars, self.include_pack = rows, mappings, include_particulars, include_pack
        says = lambda col, role: titles is not None and col < len(titles) and headers.marks_role(titles[col], role)
        self.titled = {k for k in range(len(titles or ())) if says(k, "purchase")}
        self.numeric = [force_numeric or says(m["alias"], "alias") for m in mappings]
        self.shared = Counter(m["purchase"] for m in mappings)
        self.stacks = [self._stack_order(m) for m in mappings]
        self.direction = [self._direction(m, n) for m, n in zip(mappings, self.numeric, strict=True)]
        self.on_request: set[str] = set()
        self.out: list[Row] = []

    # --- state over several rows --------------------------------------------------

    def _stack_order(self, m: Mapping) -> str | None:
        """In stacks of numbers, the end with fewer distinct values over the first stacks holds prices."""
        if m["alias"] != m["purchase"]:
            return None
        ends = []
        for row in self.rows:
            pack = at(row, m.get("pack", -1))
            stack = _numbers(at(row, m["alias"]))
            if len(stack) >= 2 and ("pack" not in m or cells.clean_pack(pack) or cells.is_pack_token(pack)):
                ends.append((stack[0][0], stack[-1][0]))
        first, last = ({e[k] for e in ends[:STACKS]} for k in (0, 1))
        if len(ends) < 2 or len(first) == len(last):
            return None
        return "price_first" if len(first) < len(last) else "alias_first"

    def _lone_price(self, k: int, m: Mapping, numeric: bool) -> bool:
        """Does the row hold a price, but neither code nor words in the code column?"""
        if not 0 <= k < len(self.rows):
            return False
        text, value = at(self.rows[k], m["alias"]), cells.real_price(at(self.rows[k], m["purchase"]))
        return value is not None and not cells.is_rating(value) and not cells.has_letters(text) and cells.strong_leading(text, numeric) is None and not _technical(text)

    def _direction(self, m: Mapping, numeric: bool) -> str | None:
        """Do prices of split rows stand above or below their codes, by majority?"""
        if m["alias"] == m["purchase"]:
            return None
        above = below = 0
        for k, row in enumerate(self.rows):
            text = at(row, m["alias"])
            if not text or cells.price(at(row, m["purchase"])) is not None or cells.strong_leading(text, numeric) is None:
                continue
            up, down = self._lone_price(k - 1, m, numeric), self._lone_price(k + 1, m, numeric)
            if up and down:
                above += self._lone_price(k - 2, m, numeric)
                below += self._lone_price(k + 2, m, numeric)
            else:
                above, below = above + 2 * up, below + 2 * down
        return "previous" if above >= 2 and above > below else "next" if below >= 2 and below > above else None

    # --- running --------------------------------------------------------------------

    def run(self) -> list[Row]:
        for k, row in enumerate(self.rows):
            if any(c.strip() for c in row):
                for place, m in enumerate(self.mappings):
                    try:
                        self._item(k, row, place, m)
                    except Dropped:
                        continue
        return self.out

    def _item(self, k: int, row: list[str], place: int, m: Mapping) -> None:
        low, high = sorted((m["alias"], m["purchase"]))
        between = " ".join(t for c in range(low + 1, high) if (t := at(row, c)))
        x = Item(row, k, m, place, self.numeric[place], at(row, m["alias"]), at(row, m["purchase"]), at(row, m.get("particulars", -1)), between, at(row, m.get("pack", -1)))
        self._refuse(x)
        if m["alias"] == m["purchase"]:
            self._dual_role(x)
            return
        for rule in (self._mixed_text, self._own_price, self._nearby_price, self._shifted_pack, self._stacked_price, self._refuse_ratings, self._text_codes, self._weak_code, self._choose_code,
                     self._pairs_in_code_cell, self._neighbour_price, self._price_above, self._text_price_and_pack, self._text_price, self._pack_for_price, self._late_code):
            rule(x)
        if not cells.is_code(x.code, x.numeric) or x.price is None:
            return
        pack = (cells.clean_pack(x.pack_cell) or x.own_pack) if self.include_pack else ""
        words = described(row, m) if self.include_particulars else ""
        self.out += [Row(words, code, round(x.price, 2), pack) for code in self._all_codes(x)]

    # --- rules ------------------------------------------------------------------------

    def _refuse(self, x: Item) -> None:
        """Price on request, words for a price, or a rating in the code's place."""
        if x.price_cell and (cells.on_request(x.price_cell) or x.price_cell.lower() == "n"):
            if code := cells.find_code(x.code_cell, True):
                self.on_request.add(code)
            raise Dropped
        if cells.has_letters(x.price_cell) and x.mapping["purchase"] not in self.titled:
            raise Dropped
        if _AMPERES.search(x.code_cell) and not _LOOSE_GROUP.search(x.code_cell) and cells.strong_leading(x.code_cell, x.numeric) is None:
            raise Dropped

    def _dual_role(self, x: Item) -> None:
        """One column for code and price: pairs within the cell, else the price of a near row."""
        pack = cells.clean_pack(x.pack_cell) if self.include_pack else ""
        pairs = list(pairs_in(x.code_cell))
        stack = self._stack_pair(x)
        own = cells.lines(x.code_cell)
        lead = cells.real_price(own[0]) if own else None
        if lead is not None:  # a price that leads the cell may belong to a code left of it
            left = [at(x.row, x.mapping["alias"] - d) for d in (1, 2)]
            code = next((c for t in left if re.fullmatch(r"\d{3,6}[ \t]\d{2,6}", t) and cells.is_code(c := cells.find_code(t, True), True)), None)
            if code is not None:
                self.out.append(Row("", code, round(lead, 2), ""))
                moved = next((p for p in pairs if round(p[1], 2) == round(lead, 2)), None)
                if moved is not None:
                    pairs.remove(moved)
        for code, value in pairs:
            if cells.is_code(code, True):
                self.out.append(Row("", code, round(value, 2), pack))
        if stack is not None and stack not in pairs:
            self.out.append(Row("", *stack, pack))
        code, value = cells.strong_leading(x.code_cell, x.numeric), cells.best(cells.line_prices(x.code_cell))
        if code is None:
            return
        if value is None:
            value = next((v for step in (1, -1) if (v := self._own_column_price(x, step)) is not None), None)
        elif stack is not None or (code, value) in pairs:
            return
        if value is not None:
            self.out.append(Row("", code, value, pack))

    def _stack_pair(self, x: Item) -> tuple[str, float] | None:
        """Code and price of a stack of two numbers, in the order that the column shows."""
        order, stack = self.stacks[x.place], _numbers(x.code_cell)
        if order is None or len(stack) != 2 or any(map(cells.is_pack_token, cells.lines(x.code_cell))):
            return None
        price, code = stack if order == "price_first" else stack[::-1]
        found = cells.find_code(code[0], True)
        return (found, price[1]) if cells.is_code(found, True) else None

    def _own_column_price(self, x: Item, step: int) -> float | None:
        for hop in range(1, OWN_HOPS + 1):
            k = x.at + step * hop
            if not 0 <= k < len(self.rows):
                return None
            text = at(self.rows[k], x.mapping["alias"])
            if cells.strong_leading(text, x.numeric) and (cells.has_letters(text) or re.search(r"\d{3,6}[ \t]\d{2,6}", text)):
                return None
            if (value := cells.best(cells.line_prices(text))) is not None:
                return value
        return None

    def _mixed_text(self, x: Item) -> None:
        if not x.code_cell or not x.price_cell:
            x.mixed = cells.mixed_pair(x.code_cell) or cells.mixed_pair(x.text)

    def _own_price(self, x: Item) -> None:
        x.price = cells.price(x.price_cell)
        if x.price is None:
            source = x.price_cell or x.pack_cell
            value, pack = cells.price_and_pack(source)
            if value is not None:
                x.price = value
                if pack and (not x.price_cell or not x.pack_cell):
                    x.own_pack = pack

    def _nearby_price(self, x: Item) -> None:
        """A titled price column on the price's side of the code, if it holds more."""
        if (x.price is None and x.price_cell) or (x.price is not None and x.mapping["purchase"] in self.titled):
            return
        code, pay = x.mapping["alias"], x.mapping["purchase"]
        side = range(code, len(x.row)) if pay >= code else range(0, code + 1)
        near = [c for c in side if c in self.titled and c not in (code, pay, x.mapping.get("pack")) and abs(c - code) <= NEAR_COLUMNS]
        values = [v for c in near if (v := cells.real_price(at(x.row, c))) is not None and not cells.is_rating(v)]
        if values and (x.price is None or max(values) > x.price):
            x.price = max(values)

    def _shifted_pack(self, x: Item) -> None:
        """A pack in the price's place, and the price behind a dash in the text."""
        if x.price is None or not cells.is_pack_token(x.price_cell) or x.pack_cell:
            return
        for text in x.texts:
            if re.search(r"(?:^|\s)-\s*\d", text) and (value := cells.last_number(text)) is not None:
                x.price, x.own_pack = value, cells.clean_pack(x.price_cell)
                return

    def _stacked_price(self, x: Item) -> None:
        if x.price is None and "\n" in x.price_cell:
            x.price = cells.best(cells.line_prices(x.price_cell))

    def _refuse_ratings(self, x: Item) -> None:
        if x.price is not None and x.price <= 500 and _AMPERES.search(x.code_cell) and _LOOSE_GROUP.search(x.code_cell) and cells.has_letters(_AMPERES.sub("", x.code_cell)):
            raise Dropped

    def _text_codes(self, x: Item) -> None:
        lead = cells.leading_code(x.text, x.numeric) if x.text else None
        x.lead_code = lead if lead and cells.is_strong(lead, x.numeric) else None
        x.text_code = x.lead_code or cells.group_code(x.text)

    def _weak_code(self, x: Item) -> None:
        """A cell without a code line must be strong itself, unless another source has a code."""
        whole = cells.find_code(x.code_cell, True) if x.code_cell else ""
        x.evidence = cells.has_code_evidence(x.code_cell) or cells.is_code(whole, True)
        if x.evidence or x.mixed or x.text_code or cells.strong_leading(x.code_cell, x.numeric):
            return
        if (re.search(r"\s", x.code_cell) and not cells.GROUP_EVIDENCE.search(x.code_cell)) or not cells.is_strong(whole, True):
            raise Dropped

    def _choose_code(self, x: Item) -> None:
        """The code cell's code, or the one that leads the text if the cell is weak, stale or less dense."""
        x.code = cells.find_code(x.code_cell, x.numeric)
        if x.price is None:
            return
        if not x.code and x.text_code:
            x.code, x.numeric = x.text_code, True
        if x.code and x.lead_code and x.lead_code != x.code:
            before = cells.find_code(at(self.rows[x.at - 1], x.mapping["alias"]), x.numeric) if x.at else ""
            digits = lambda s: sum(map(str.isdigit, s))
            if not x.evidence or before == x.code or digits(x.lead_code) >= digits(x.code):
                x.code, x.numeric = x.lead_code, True

    def _pairs_in_code_cell(self, x: Item) -> None:
        """Prices that stand with the code in its own cell."""
        pair = cells.inline_pair(x.code_cell)
        if pair and pair[0] == x.code:
            x.price = pair[1]
        pairs = pairs_in(x.code_cell) if x.code else []
        own = next((v for c, v in pairs if c == x.code), None)
        shifted = x.price is not None and len(pairs) >= 2 and cells.GROUP.search(x.price_cell)
        doubtful = x.price is None or x.mapping["purchase"] not in self.titled or self.shared[x.mapping["purchase"]] > 1
        if own is not None and (shifted or doubtful):
            x.price = own

    def _is_strong(self, x: Item) -> bool:
        return cells.is_strong(x.code or x.text_code or "", x.numeric)

    def _neighbour_price(self, x: Item) -> None:
        """The price of a near row without a code, first in the direction that the table shows."""
        if x.price is not None or not self._is_strong(x):
            return
        code, pay = x.mapping["alias"], x.mapping["purchase"]
        for step in (-1, 1) if self.direction[x.place] == "previous" else (1, -1):
            for hop in range(1, HOPS + 1):
                k = x.at + step * hop
                if not 0 <= k < len(self.rows):
                    break
                text = at(self.rows[k], code)
                if cells.strong_leading(text, x.numeric) is not None or cells.has_code_evidence(text):
                    break
                value = cells.real_price(at(self.rows[k], pay))
                if value is None or cells.is_rating(value) or _technical(text):
                    continue
                x.price = round(value, 2)
                x.own_pack = x.own_pack or cells.clean_pack(at(self.rows[k], x.mapping.get("pack", -1)))
                return

    def _price_above(self, x: Item) -> None:
        """A stack of bare numbers in the code cell above."""
        if x.price is None and x.code and x.at and self._is_strong(x):
            text = at(self.rows[x.at - 1], x.mapping["alias"])
            if text and not cells.has_code_evidence(text) and not cells.has_letters(text):
                x.price = max((v for v in cells.line_prices(text) if not cells.is_rating(v)), default=None)

    def _text_price_and_pack(self, x: Item) -> None:
        if x.price is None and (x.code or x.text_code):
            for text in x.texts:
                value, pack = cells.price_and_pack(text)
                if value is not None:
                    x.price = value
                    x.own_pack = x.own_pack or ("" if x.pack_cell else pack)
                    return

    def _text_price(self, x: Item) -> None:
        """A number that ends the text, unless it counts pieces or the code is on request."""
        if x.price is not None or not (x.code or x.text_code) or {x.code, x.text_code} & self.on_request:
            return
        counts = x.mapping["purchase"] in self.titled and not x.price_cell and x.pack_cell and any(map(_PACK_CONTEXT.search, x.texts))
        if not counts:
            x.price = next((v for t in x.texts if (v := cells.trailing_price(t)) is not None), None)

    def _pack_for_price(self, x: Item) -> None:
        if x.price is not None and x.price < LOWEST and cells.is_pack_token(x.price_cell) and (x.code or x.text_code):
            value = next((v for t in x.texts if (v := cells.trailing_price(t)) is not None), None)
            if value is not None:
                x.price, x.own_pack = value, cells.clean_pack(x.price_cell)

    def _late_code(self, x: Item) -> None:
        if not x.code and x.price is not None and x.text_code:
            x.code, x.numeric = x.text_code, True
        if x.mixed and x.price is None:
            (x.code, x.price), x.numeric = x.mixed, True

    def _all_codes(self, x: Item) -> list[str]:
        """The code, and all other strong codes on lines of its cell; they share the price."""
        codes = {x.code: None}
        if x.code_cell and cells.find_code(x.code_cell, x.numeric) == x.code:
            for line in cells.lines(x.code_cell):
                other = cells.find_code(line, x.numeric)
                tail = x.code.isdigit() and other.isdigit() and len(other) < len(x.code) and x.code.endswith(other)
                if cells.is_strong(other, x.numeric) and not tail:
                    codes[other] = None
        return list(codes)


def _technical(text: str) -> bool:
    first = next(iter(cells.lines(text)), "")
    return bool(re.fullmatch(r"\d+(?:\.\d+)?\s*A", first, re.I) or re.match(r"IEC\s*\d", first, re.I))


def _numbers(text: str) -> list[tuple[str, float]]:
    """Lines that are numbers of 50 at least; none if there is any letter."""
    if cells.has_letters(text):
        return []
    return [(t, round(v, 2)) for x in cells.lines(text) if re.fullmatch(cells.NUMBER, t := cells.flat(x)) and (v := cells.real_price(t)) is not None]


def mapped_rows(rows: list[list[str]], mappings: list[Mapping], headers: HeaderReader, titles: list[str] | None = None, *, force_numeric: bool = False, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """Price rows of the data rows of a table. ``titles``: its header texts, if it has any."""
    return MappedParser(rows, mappings, headers, titles, force_numeric, include_particulars, include_pack).run()
