import sys

from rollcall.cli import main

sys.exit(main())
