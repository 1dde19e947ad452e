import sys

from marquee.cli import main

main(sys.argv[1:])
