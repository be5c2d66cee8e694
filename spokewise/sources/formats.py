"""CSV format bundles (S5) mapped to Spark CSV reader options (FIXTURES.md §2)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CsvFormat:
    """A named bundle of parse options, like a file format object in the dialect.

    ``quote=None`` means fields are never enclosed. ``escape_unenclosed`` takes
    the meaning from a delimiter, a line end, a quote or itself in a field that
    is not enclosed. Spark's reader has no such option and reads a record per
    line; files that need either are found and cut by ``sources.records``.
    ``timestamp_formats=("AUTO",)`` finds the format of each date and time column
    from its tokens (``loader.AUTO_FORMATS``).
    """

    delimiter: str = ","
    record_delimiter: str | None = None
    quote: str | None = None
    skip_header: int = 0
    trim_space: bool = False
    error_on_column_count_mismatch: bool = True
    empty_field_as_null: bool = True
    null_if: tuple[str, ...] = ()
    escape_unenclosed: str | None = None
    timestamp_formats: tuple[str, ...] = field(default_factory=tuple)

    def reader_options(self) -> dict[str, str]:
        if self.skip_header not in (0, 1):
            raise ValueError("skip_header must be 0 or 1")
        opts = {
            "sep": self.delimiter,
            "header": "true" if self.skip_header else "false",
            "ignoreLeadingWhiteSpace": str(self.trim_space).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim_space).lower(),
            "mode": "PERMISSIVE",
            "multiLine": "false",
            "enforceSchema": "true",
        }
        if self.record_delimiter not in (None, "\n"):
            opts["lineSep"] = self.record_delimiter
        if self.quote is None:
            opts["quote"] = "\u0000"
        else:
            opts["quote"] = self.quote
            # a quote inside an enclosed field is written doubled
            opts["escape"] = self.quote
        if self.empty_field_as_null or "" in self.null_if:
            opts["nullValue"] = ""
        nulls = [n for n in self.null_if if n != ""]
        if len(nulls) == 1 and not (self.empty_field_as_null or "" in self.null_if):
            opts["nullValue"] = nulls[0]
        return opts

    def extra_null_tokens(self) -> tuple[str, ...]:
        """NULL tokens the reader's single ``nullValue`` cannot express; mapped after the read."""
        opts = self.reader_options()
        return tuple(n for n in self.null_if if n != "" and n != opts.get("nullValue"))


# fixed values: the three formats the reference declares
FORMAT_A = CsvFormat(delimiter=",", quote='"', error_on_column_count_mismatch=False,
                     empty_field_as_null=True, skip_header=1)
FORMAT_B = CsvFormat(delimiter=",", record_delimiter="\n", skip_header=0, quote='"',
                     trim_space=False, error_on_column_count_mismatch=True,
                     escape_unenclosed="\\", null_if=("",))
FORMAT_C = CsvFormat()
