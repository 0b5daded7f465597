import sys

from closeledger.cli import main

sys.exit(main())
