import sys
from pathlib import Path

# The tests import the library and the entry module from the repository's top.
sys.path.insert(0, str(Path(__file__).parent))
