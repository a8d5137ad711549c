from cdrflow.cli import main

main()
