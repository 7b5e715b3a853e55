"""Line items inside a check document, handled as arrays within the row.

A check is one JSON document, so everything that concerns a single check (does it hold a
target item, what is its composition) is an array expression: no explode, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from tillwise.functions.text import fmt_g

# The document paths of a line item (code, name, quantity, price in cents).
CHECK_SCHEMA = "ls array<struct<p:string,n:string,q:string,pr:string>>"

ItemTest = Callable[[Column], Column]


def scalar_sql(path: str) -> str:
    """SQL for a text field read by from_json: NULL where it was an object or array.

    from_json hands over a nested value as its JSON text. A scalar that starts with a bracket
    is hardly ever valid JSON as a whole, and only such values are parsed again.
    """
    return f"if(substring({path}, 1, 1) IN ('{{', '[') AND try_parse_json({path}) IS NOT NULL, NULL, {path})"


def line_items(check: str = "check") -> Column:
    """Check document column -> array of (code, name, quantity, whole_quantity, price).

    Bad numbers become NULL. ``whole_quantity`` is NULL for a fractional quantity; NULL or
    malformed documents give a NULL array. An object or array in place of a scalar is NULL.
    """
    code, name, quantity, price = (scalar_sql(f"i.{path}") for path in ("p", "n", "q", "pr"))
    return F.expr(
        f"""
        transform(from_json(`{check}`, '{CHECK_SCHEMA}').ls, i -> named_struct(
            'code', {code},
            'name', {name},
            'quantity', try_cast({quantity} AS DOUBLE),
            'whole_quantity', try_cast({quantity} AS BIGINT),
            'price', try_cast({price} AS DECIMAL(38,9))
        ))
        """
    )


def parsed_line_items(check: str = "check") -> Column:
    """What ``line_items`` gives, from a document that was parsed to VARIANT when it was landed.

    Fields are extracted from the parsed form; no text is parsed. Numbers in place of texts come in
    their shortest form (1.50 as 1.5).
    """

    def scalar(path: str) -> str:
        text = f"try_variant_get(i, '$.{path}', 'string')"
        nested = f"schema_of_variant(try_variant_get(i, '$.{path}', 'variant'))"
        return f"if({nested} LIKE 'OBJECT%' OR {nested} LIKE 'ARRAY%', NULL, {text})"

    return F.expr(
        f"""
        transform(try_variant_get(`{check}`, '$.ls', 'array<variant>'), i -> named_struct(
            'code', {scalar('p')},
            'name', {scalar('n')},
            'quantity', try_cast({scalar('q')} AS DOUBLE),
            'whole_quantity', try_cast({scalar('q')} AS BIGINT),
            'price', try_cast({scalar('pr')} AS DECIMAL(38,9))
        ))
        """
    )


def matches_code_and_name(targets: Iterable[tuple[str, str]]) -> ItemTest:
    """Item with a listed (code, name) pair and a positive quantity."""
    pairs = [F.struct(F.lit(code).alias("code"), F.lit(name).alias("name")) for code, name in targets]
    return lambda item: (
        F.struct(item["code"].alias("code"), item["name"].alias("name")).isin(*pairs)
        & (item["quantity"] > 0)
    )


def matches_paid_code(codes: Iterable[str]) -> ItemTest:
    """Item with a listed code, a positive price and a positive whole quantity."""
    listed = list(codes)
    return lambda item: item["code"].isin(*listed) & (item["price"] > 0) & (item["whole_quantity"] > 0)


def matches_code(code: str) -> ItemTest:
    return lambda item: item["code"] == F.lit(code)


def contains_item(items: Column, test: ItemTest) -> Column:
    """TRUE when any item passes, otherwise FALSE (also for a missing document)."""
    return F.coalesce(F.exists(items, lambda item: F.coalesce(test(item), F.lit(False))), F.lit(False))


def priced_composition(items: Column, separator: str = "-") -> Column:
    """Distinct non-zero-priced item codes, sorted as text and joined; NULL when there are none."""
    priced = F.filter(items, lambda item: item["code"].isNotNull() & (item["price"] != 0))
    codes = F.array_sort(F.array_distinct(F.transform(priced, lambda item: item["code"])))
    return F.when(F.size(codes) > 0, F.array_join(codes, separator))


def _sold(items: Column) -> Column:
    return F.filter(items, lambda item: item["quantity"] > 0)


def name_composition(items: Column, separator: str = ", ") -> Column:
    """Distinct names of the items sold, sorted and joined; NULL when there are none."""
    names = F.filter(F.transform(_sold(items), lambda item: item["name"]), lambda name: name.isNotNull())
    ordered = F.array_sort(F.array_distinct(names))
    return F.when(F.size(ordered) > 0, F.array_join(ordered, separator))


def _join_texts(texts: Column, separator: str) -> Column:
    present = F.filter(texts, lambda text: text.isNotNull())
    return F.when(F.size(present) > 0, F.array_join(present, separator))


def item_details(items: Column, separator: str = "\n") -> Column:
    """``name | code | q=.. | pr=..`` for each item sold, in document order.

    An item lacking any of the four values is skipped.
    """
    texts = F.transform(
        _sold(items),
        lambda item: F.concat(
            item["name"], F.lit(" | "), item["code"],
            F.lit(" | q="), fmt_g(item["quantity"]), F.lit(" | pr="), fmt_g(item["price"]),
        ),
    )
    return _join_texts(texts, separator)


def target_item_details(items: Column, test: ItemTest, separator: str = ", ") -> Column:
    """``name | code | dollars | quantity`` for each target item, in document order."""
    targets = F.filter(items, lambda item: F.coalesce(test(item), F.lit(False)))
    texts = F.transform(
        targets,
        lambda item: F.when(
            item["price"].isNotNull(),
            F.concat(
                item["name"], F.lit(" | "), item["code"], F.lit(" | "),
                F.format_string("%.2f", item["price"].cast("double") / F.lit(100)),
                F.lit(" | "), fmt_g(item["quantity"]),
            ),
        ),
    )
    return _join_texts(texts, separator)
