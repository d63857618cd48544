import sys

from kiln.cli import main

main(sys.argv[1:])
