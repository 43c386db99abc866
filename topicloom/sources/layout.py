"""Where the tables of the sessions are."""

from dataclasses import dataclass

DOCS_TABLE = "docs"
MODEL_INPUT_TABLE = "model-input"
MODEL = "clustering-model"
CATEGORIZED_TABLE = "categorized"
SUMMARY_TEXT = "summary"
#: The partition column of tables that sessions share.
SESSION = "session"


@dataclass(frozen=True)
class SessionLayout:
    """Fixed names below ``base/session<tag>``, or below ``folder`` if given.

    With ``partitioned`` all sessions share the tables below ``base`` (or ``folder``)
    and each is a partition of them, ``<table>/session=<tag>``. A step replaces the
    partition of its own session only, also if it has no rows, and sessions that
    run at the same time do not meet. ``tables.read_sessions`` reads over sessions.
    """

    base: str
    tag: int
    folder: str | None = None
    partitioned: bool = False

    def __post_init__(self):
        if isinstance(self.tag, bool) or not isinstance(self.tag, int):
            raise ValueError(f"session tag must be an integer: {self.tag!r}")

    @property
    def root(self) -> str:
        own = "" if self.partitioned else f"/session{self.tag}"
        return (self.folder or f"{self.base.rstrip('/')}{own}").rstrip("/")

    def path(self, table: str) -> str:
        """Where this session's part of a table is."""
        return f"{self.table(table)}/{SESSION}={self.tag}" if self.partitioned else self.table(table)

    def table(self, table: str) -> str:
        """Where a table is: of all sessions with ``partitioned``, else of this one."""
        return f"{self.root}/{table}"

    @property
    def docs(self) -> str:
        return self.path(DOCS_TABLE)

    @property
    def model_input(self) -> str:
        return self.path(MODEL_INPUT_TABLE)

    @property
    def model(self) -> str:
        return self.path(MODEL)

    @property
    def categorized(self) -> str:
        return self.path(CATEGORIZED_TABLE)

    @property
    def summary(self) -> str:
        return self.path(SUMMARY_TEXT)
