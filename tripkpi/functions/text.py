"""Names and literals inside SQL expressions.

Expressions are written as SQL text: the plan is the same as with Column objects, and the driver
needs one call per expression to build it, where Columns take one per operator.
"""


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows(structs: list[str]) -> str:
    """Expression that turns one row into one row per struct."""
    return f"inline(array({', '.join(structs)}))"


def record(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{key}', {value}" for key, value in fields.items()) + ")"
