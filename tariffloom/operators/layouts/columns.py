"""Layouts where columns, not headers, tell codes from prices: compact, dense, sparse, packed, horizontal."""

from __future__ import annotations

import re

from . import cells
from .cells import HIGHEST, LOWEST, Row
from .headers import HeaderReader, inferred, nearest

Matrix = list[list[str]]
_NUMBERS = re.compile(r"(?<![A-Za-z0-9])\d{2,7}(?:,\d{3})*(?:\.\d+)?(?![A-Za-z0-9])")


def at(row: list[str], col: int) -> str:
    return row[col].strip() if 0 <= col < len(row) else ""


def _width(matrix: Matrix) -> int:
    return max(map(len, matrix), default=0)


def _voted(matrix: Matrix, votes, least: int, near: int | None = None, cols=None) -> int | None:
    """The column with most votes, the first of equals or the one nearest to ``near``; none below ``least``."""
    ranked = [(votes(col), col) for col in (range(_width(matrix)) if cols is None else cols)]
    ranked = [r for r in ranked if r[0] >= max(1, least)]
    order = (lambda r: (-r[0], abs(r[1] - near), r[1])) if near is not None else (lambda r: (-r[0], r[1]))
    return min(ranked, key=order)[1] if ranked else None


# --- compact: a column of codes, a column of stacked prices and packs -----------


def _stacked(text: str) -> tuple[float | None, str]:
    """Best price and first pack of a cell, unless it holds codes."""
    if cells.LONG_GROUP.search(text):
        return None, ""
    found, pack = [], ""
    for line in cells.lines(text):
        if (p := cells.real_price(line)) is not None:
            found.append(p)
            continue
        pack = pack or cells.clean_pack(line)
        if found and pack:
            break
    return cells.best(found), pack


def compact_rows(matrix: Matrix, headers: HeaderReader, include_pack: bool = False) -> list[Row]:
    """Code groups in one column, prices with packs below them in a column that a header marks as price."""
    coded = lambda row, col: bool(cells.LONG_GROUP.search(at(row, col)))
    code = _voted(matrix, lambda c: sum(coded(r, c) for r in matrix), 4)
    if code is None:
        return []
    marked = sorted({c for row in matrix[:12] for c in range(len(row)) if c != code and headers.marks_role(at(row, c), "purchase")})
    rows = [r for r in matrix if coded(r, code)]

    def points(col: int) -> int:
        total = 0
        for row in rows:
            value, pack = _stacked(at(row, col))
            if value is not None:
                total += 1 + (len(cells.lines(at(row, col))) >= 2) + 2 * bool(pack)
        return total

    paid = _voted(matrix, points, 8, code, marked)
    if paid is None:
        return []
    out = []
    for row in rows:
        found, (value, pack) = cells.find_code(at(row, code), True), _stacked(at(row, paid))
        if cells.is_code(found, True) and value is not None:
            out.append(Row("", found, value, pack if include_pack else ""))
    out = cells.best_rows(out)
    return out if len(out) >= 4 else []


# --- dense: code, price and description in one column -------------------------------


def _dense_price(text: str, headers: HeaderReader) -> float | None:
    if cells.on_request(text):
        return None
    stated = [p for x in cells.lines(text) if not cells.GROUP.search(x) and (p := cells.price(x)) is not None]
    if stated:
        return next((round(p, 2) for p in stated if p >= LOWEST), None)
    rest = cells.GROUP.sub(" ", text)
    if cells.has_letters(rest) and not headers.marks_role(rest, "purchase"):
        return None
    values = [v for t in _NUMBERS.findall(rest) if LOWEST <= (v := float(t.replace(",", ""))) <= HIGHEST]
    return round(values[-1], 2) if values else None


def dense_rows(matrix: Matrix, headers: HeaderReader, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """One code group and its price in each cell of a column; packs perhaps beside it."""
    data = _voted(matrix, lambda c: sum(bool(cells.GROUP.search(at(r, c))) for r in matrix), 3)
    if data is None:
        return []
    others = [c for c in range(_width(matrix)) if c != data]
    packs = _voted(matrix, lambda c: sum(bool(cells.clean_pack(at(r, c))) for r in matrix), 3, data, others) if include_pack else None
    out = []
    for row in matrix:
        text = at(row, data)
        if len(cells.GROUP.findall(text)) != 1:
            continue
        code, value = cells.find_code(text, True), _dense_price(text, headers)
        if cells.is_code(code, True) and value is not None:
            words = " ".join(c for k, c in enumerate(row) if k not in (data, packs) and c.strip()).strip() if include_particulars else ""
            out.append(Row(words, code, value, cells.clean_pack(at(row, packs)) if packs is not None else ""))
    out = cells.best_rows(out)
    return out if len(out) >= 3 else []


# --- sparse: roles inferred from what the cells hold ---------------------------------


def sparse_rows(matrix: Matrix, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """Row by row with inferred roles; a row of text alone continues the description before it."""
    maps = inferred(matrix)
    text = next((m["particulars"] for m in maps if "particulars" in m), None) if include_particulars else None
    taken = {m[k] for m in maps for k in ("alias", "purchase")}
    rows: Matrix = []
    for row in matrix if maps else []:
        if not any(c.strip() for c in row):
            continue
        continues = text is not None and at(row, text) and not any(at(row, c) for c in taken)
        if continues and rows:
            if text < len(rows[-1]):
                rows[-1][text] += " " + at(row, text)
        else:
            rows.append(list(row))
    out = []
    for row in rows:
        for m in maps:
            code, value = cells.find_code(at(row, m["alias"])), cells.price(at(row, m["purchase"]))
            if cells.is_code(code) and value is not None:
                out.append(Row(described(row, m) if include_particulars else "", code, round(value, 2), cells.clean_pack(at(row, m.get("pack", -1))) if include_pack else ""))
    return cells.best_rows(out)


def described(row: list[str], mapping: dict[str, int]) -> str:
    """The mapped description, else the longest cell that has no other role."""
    used = {mapping[k] for k in ("alias", "purchase", "pack") if k in mapping}
    return cells.flat(at(row, mapping.get("particulars", -1))) or cells.longest_unused(row, used)


# --- packed: many items in the lines of one row ---------------------------------------


def collapsed(matrix: Matrix) -> list[str] | None:
    """The table as one row of stacked cells, if it is made of fragments."""
    filled = [sum(bool(c.strip()) for c in row) for row in matrix]
    if len(matrix) < 4 or sum(n <= 1 for n in filled) < 2:
        return None
    row = ["\n".join(s for r in matrix if (s := at(r, c))) for c in range(_width(matrix))]
    return row if sum(map(bool, row)) >= 2 and row not in matrix else None


def _entries(text: str) -> list[tuple[str, str]]:
    """Each code line with the describing lines next to it."""
    rows, out = cells.lines(text), []
    for k, line in enumerate(rows):
        if not cells.is_code_line(line):
            continue
        near = [rows[j] for j in (k - 1, k + 1) if 0 <= j < len(rows)]
        words = [x for x in near if not cells.is_code_line(x) and not cells.is_heading(x) and (cells.price(x) is None or re.search("[A-Za-z+/]", x))]
        out.append((cells.clean(line), " / ".join(dict.fromkeys(words))))
    return out


def packed_rows(matrix: Matrix, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """Cells with several codes beside cells with several prices, paired line by line."""
    one, out = collapsed(matrix), []
    for row in ([one] if one else []) + matrix:
        codes = [k for k, c in enumerate(row) if cells.count_codes(c) >= 2]
        paid = [k for k, c in enumerate(row) if cells.count_prices(c) >= 2 and cells.count_packs(c) < 2]
        packs = [k for k, c in enumerate(row) if cells.count_packs(c) >= 2] if include_pack else []
        for code in codes:
            pay = nearest(code, paid)
            if pay is None:
                break
            paid.remove(pay)
            pack = max(packs, key=lambda k: (cells.pack_rank(row[k]), -abs(k - code), k > code, k), default=None)  # noqa: B023
            sizes = cells.pack_tokens(row[pack]) if pack is not None else []
            texts = [cells.lines(c) for k, c in enumerate(row) if k not in (code, pay, pack) and c.strip() and not cells.count_codes(c) and not cells.count_prices(c)] if include_particulars else []
            for k, ((alias, near), line) in enumerate(zip(_entries(row[code]), cells.lines(row[pay]), strict=False)):
                value = cells.price(line)
                if value is None:
                    continue
                words = [t for col in texts if (t := col[k] if k < len(col) else col[0] if len(col) == 1 else "")]
                out.append(Row((" / ".join(words) or near) if include_particulars else "", alias, round(value, 2), cells.clean_pack(sizes[k]) if k < len(sizes) else ""))
    return cells.best_rows(out)


# --- horizontal: items are columns, roles are rows ----------------------------------


def horizontal_rows(matrix: Matrix, headers: HeaderReader, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """Blocks of rows whose labels name roles; one item for each further column.

    Ragged rows count as filled up with empty cells. The description of an item
    is the nearest cell above its code in a row without a role.
    """
    if len(matrix) < 4 or not matrix[0] or len(matrix[0]) < 2:
        return []
    roles = [headers.role_of_label(at(row, 0)) for row in matrix]
    if sum(r is not None for r in roles) < 2:
        return compact_horizontal_rows(matrix, headers, include_particulars, include_pack)
    blocks: list[dict[str, int]] = [{}]
    for k, role in enumerate(roles):
        if role == "alias" and "alias" in blocks[-1] and len(blocks[-1]) >= 2:
            blocks.append({})
        if role is not None:
            blocks[-1].setdefault(role, k)
    out = []
    for block in blocks:
        if "alias" not in block or "purchase" not in block:
            continue
        for col in range(1, len(matrix[0])):
            code, value = cells.find_code(at(matrix[block["alias"]], col)), cells.price(at(matrix[block["purchase"]], col))
            if not cells.is_code(code) or value is None:
                continue
            words = next((t for k in range(block["alias"] - 1, -1, -1) if roles[k] is None and (t := at(matrix[k], col))), "") if include_particulars else ""
            pack = cells.clean_pack(at(matrix[block["pack"]], col)) if include_pack and "pack" in block else ""
            out.append(Row(words, code, round(value, 2), pack))
    return out or compact_horizontal_rows(matrix, headers, include_particulars, include_pack)


def compact_horizontal_rows(matrix: Matrix, headers: HeaderReader, include_particulars: bool = False, include_pack: bool = False) -> list[Row]:
    """The same, collapsed into one column: a cell with codes, then a cell with their prices."""
    main = _voted(matrix, lambda c: sum(bool(at(r, c)) for r in matrix), 2)
    texts = [t for row in matrix if main is not None and (t := at(row, main))]
    out = []
    for text, following in zip(texts, texts[1:], strict=False):
        if not headers.marks_role(text, "alias") or not headers.marks_role(following, "purchase"):
            continue
        own = [x for x in cells.lines(text) if not headers.marks_role(x, "alias")]
        codes = list(dict.fromkeys(t for x in own for t in re.findall(r"[A-Z0-9][A-Z0-9\-_/.]{2,}", x.upper()) if cells.is_code(t)))
        values, packs, words, in_packs = [], [], [], False
        for line in cells.lines(following):
            if headers.marks_role(line, "purchase"):
                continue
            if include_pack and headers.marks_role(line, "pack"):
                in_packs = True
            elif (p := cells.price(line)) is None:
                words.append(line)
            elif in_packs and cells.is_small_whole(p):
                packs.append(str(int(p)))
            else:
                values.append(p)
        if len(values) == 1:
            values *= len(codes)
        pairs = list(zip(codes, values, strict=False))
        labels = [x for x in own if cells.price(x) is None and not cells.is_code(cells.clean(x))]
        said = " ".join(labels + words) if include_particulars else ""
        for k, (code, value) in enumerate(pairs):
            pack = packs[k] if len(packs) == len(pairs) else packs[0] if len(packs) == 1 else ""
            out.append(Row(said, code, round(value, 2), pack if include_pack else ""))
    return out
