"""Scalar column functions (native Catalyst expressions only)."""

from .dates import *  # noqa: F401,F403
from .keys import hash_bucket, with_hash_bucket  # noqa: F401
from .strings import *  # noqa: F401,F403
