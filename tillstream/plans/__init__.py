"""Plan-level helpers: size-checked broadcast and plan inspection."""

from tillstream.plans.broadcast import broadcast_bounded  # noqa: F401
from tillstream.plans.inspect import plan_text  # noqa: F401
