"""python -m waybill"""

import sys

from .cli import main

sys.exit(main())
