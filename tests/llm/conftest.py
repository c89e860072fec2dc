import sys
from pathlib import Path

from hypothesis import settings

sys.path.insert(0, str(Path(__file__).resolve().parent))
# Other work on the machine must not fail a test.
settings.register_profile("no-deadline", deadline=None)
settings.load_profile("no-deadline")
