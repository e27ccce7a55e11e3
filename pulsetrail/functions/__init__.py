from .text import *  # noqa: F401,F403
from .time import *  # noqa: F401,F403
