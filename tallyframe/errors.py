"""Errors with codes."""


class EngineError(Exception):
    """An error with a code: INVALID, NOT_FOUND, ORDER, OOM, SQL."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


class OrderError(EngineError):
    """An operation that depends on the order of rows was asked for without one."""

    def __init__(self, what: str):
        super().__init__("ORDER", f"{what} needs an order of rows: use Frame.ordered(...) or over(order_by=...)")


class ValidationError(EngineError):
    """A bad value of an imported row."""

    def __init__(self, message: str, row: int | None = None, field: str | None = None):
        at = "".join([f" row {row}" if row is not None else "", f" field {field!r}" if field else ""])
        super().__init__("INVALID", f"{message}{':' if at else ''}{at}")
        self.row, self.field = row, field
