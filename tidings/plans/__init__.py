"""Named queries over the driver tables. Importing this package registers
all of them in :mod:`tidings.plans.registry`."""

from tidings.plans import q_text  # noqa: F401
from tidings.plans import q_mail  # noqa: F401
from tidings.plans import q_summary  # noqa: F401
from tidings.plans import q_digest  # noqa: F401
from tidings.plans import q_stream  # noqa: F401
from tidings.plans import q_plugins  # noqa: F401
from tidings.plans import q_settings  # noqa: F401
