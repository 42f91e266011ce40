"""Raw source contracts, storage readers and the test-fixture derivation."""

from touchcredit.sources.fixtures import derive_sources, load_fixture_sources  # noqa: F401
from touchcredit.sources.readers import RawSources, read_sources, write_sources  # noqa: F401
from touchcredit.sources.schemas import SOURCE_SCHEMAS  # noqa: F401
