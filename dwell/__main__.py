from dwell.plans.cli import main

main()
