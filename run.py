"""Script for spark-submit."""

from roompulse.__main__ import main

main()
